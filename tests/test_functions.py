from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartpulse.functions import labels as L
from cartpulse.functions import measures as M
from cartpulse.functions import text as T
from tests.conftest import rows_of


@pytest.mark.parametrize(
    ("ladder", "unknown", "wanted"),
    [
        (L.DELAY_LADDER, L.DELAY_UNKNOWN, {
            None: "N/A", -8.0: "7+ hari lebih cepat", -7.0: "7+ hari lebih cepat",
            -6.0: "1-7 hari lebih cepat", -1.0: "1-7 hari lebih cepat", -0.5: "Tepat waktu",
            0.0: "Tepat waktu", 0.5: "1-7 hari terlambat", 7.0: "1-7 hari terlambat",
            7.1: "8-14 hari terlambat", 14.0: "8-14 hari terlambat", 14.1: "14+ hari terlambat"}),
        (L.SHIPPING_LADDER, L.SHIPPING_UNKNOWN, {
            None: "Belum Terkirim", 3.0: "0-3 hari", 3.1: "4-7 hari", 7.0: "4-7 hari",
            14.0: "8-14 hari", 21.0: "15-21 hari", 22.0: "22+ hari"}),
        (L.APPROVAL_LADDER, None, {
            1.0: "< 1 jam", 6.0: "1-6 jam", 24.0: "6-24 jam", 24.1: "1-2 hari",
            48.0: "1-2 hari", 49.0: "2+ hari"}),
    ],
)
def test_ladders(frame, ladder, unknown, wanted):
    df = frame("v double", [(v,) for v in wanted])
    found = dict(rows_of(df.select("v", L.at_most(F.col("v"), ladder, unknown))))
    assert found == wanted


def test_levels(frame):
    df = frame("v double", [(v,) for v in (0.0, 0.01, 5.0, 5.01, 10.0, 10.01)])
    found = dict(rows_of(df.select("v", L.above(F.col("v"), L.NULL_IMPACT))))
    assert found == {
        0.0: "✅ Complete", 0.01: "✅ Low Impact", 5.0: "✅ Low Impact", 5.01: "⚡ Medium Impact",
        10.0: "⚡ Medium Impact", 10.01: "⚠️ High Impact",
    }
    df = frame("v double", [(v,) for v in (5000.0, 5001.0, 10000.0, 10001.0)])
    found = dict(rows_of(df.select("v", L.above(F.col("v"), L.ROI_LEVELS))))
    assert found == {5000.0: "Low ROI", 5001.0: "Medium ROI", 10000.0: "Medium ROI", 10001.0: "High ROI"}
    df = frame("v double", [(v,) for v in (9.99, 10.0, 20.0, 50.0)])
    found = dict(rows_of(df.select("v", L.from_(F.col("v"), L.DRIVER_LEVELS))))
    assert found == {9.99: "Minor Driver", 10.0: "Moderate Driver", 20.0: "Major Driver", 50.0: "Critical Driver"}


def test_roll_up_counts_orders_and_customers_without_distinct(frame):
    df = frame(
        "cat string, customer string, order_id string, n_items bigint, price_units bigint,"
        " review_score int",
        [
            ("a", "c1", "o1", 1, 10_000, 5),
            ("a", "c1", "o1", 1, 20_000, 5),
            ("a", "c1", "o2", 1, 30_000, None),
            ("a", "c2", "o3", 1, 5_000, 1),
            ("b", "c2", "o3", 1, 5_000, 1),
            ("b", None, "o4", 1, 5_000, 2),
        ],
    )
    found = M.roll_up(
        df,
        ["cat"],
        {
            "orders": M.distinct("order_id"),
            "customers": M.distinct("customer"),
            "repeat": M.count_where(F.col("distinct_order_id") > 1, "repeat"),
            "revenue": M.total("price"),
            "price": M.mean_money("price"),
            "score": M.mean("review_score"),
            "low": M.share(L.negative(F.col("review_score")), "low"),
        },
        through=("customer", "order_id"),
    )
    assert rows_of(found) == [
        ("a", 3, 2, 1, 6.5, 1.625, 11 / 3, 25.0),
        ("b", 2, 2, 0, 1.0, 0.5, 1.5, 100.0),
    ]
    assert "distinct" not in str(found._jdf.queryExecution().optimizedPlan()).lower().replace(
        "distinct_", ""
    )


def test_roll_up_of_nothing(frame):
    df = frame("n_items bigint, price_units bigint, review_score int", [])
    found = M.roll_up(df, [], {"n": M.rows(), "items": M.items(), "score": M.mean("review_score")})
    assert rows_of(found) == [(0, 0, None)]


def test_sums_do_not_depend_on_order(spark):
    df = spark.range(10_000).select(
        F.lit(1).cast("long").alias("n_items"),
        M.money_units(F.round(F.rand(3) * 100, 2)).alias("price_units"),
    )
    total = {"t": M.total("price"), "m": M.mean_money("price")}
    kept = df.persist()
    found = {tuple(M.roll_up(kept.repartition(n), [], total).first()) for n in (1, 3, 7, 16)}
    kept.unpersist()
    assert len(found) == 1


# ------------------------------------------------------------------ texts


def keyword_tokens_by_hand(text: str) -> list[str]:
    words = [w for w in re.sub("[^a-zà-ü]", " ", text.lower()).split(" ") if len(w) > 2]
    return words + [f"{a}_{b}" for a, b in zip(words, words[1:], strict=False)]


TEXTS = st.text(alphabet="abcz ÁÀéüñõß.,!?-_1\n\t ", max_size=60)


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXTS, min_size=20, max_size=60))
def test_native_tokens_equal_the_rule(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = dict(
        (row.i, row.tokens) for row in T.add_keyword_tokens(df, "t", "tokens").collect()
    )
    assert found == {i: keyword_tokens_by_hand(t) for i, t in enumerate(texts)}


def test_tokens_of_one_word_and_of_none(frame):
    df = frame("t string", [("ótimo",), ("",), ("a b",)])
    found = [row.tokens for row in T.add_keyword_tokens(df, "t", "tokens").collect()]
    assert found == [["ótimo"], [], []]


def test_squeezed_words_delete_instead_of_splitting(frame):
    df = frame("t string", [("Não-gostei do PRODUTO! Péssimo 10x",)])
    assert df.select(T.squeezed_words(F.col("t"))).first()[0] == ["nãogostei", "produto", "péssimo"]


def test_stop_words(spark):
    words = T.stop_words()
    assert {"não", "para", "produto", "comprei", "havia", "ter"} <= set(words)
    assert "produto" not in T.stop_words(domain=False)
