"""Tables kept by partial sums: equal to full runs, after any day, whatever a day changes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartpulse.functions.labels import MISSING
from cartpulse.operators.fact import Inputs
from cartpulse.plans import catalogue, dashboards, kept
from cartpulse.plans.mart import LiveMart
from cartpulse.schemas import INPUTS
from cartpulse.sources import testtables
from tests.conftest import SMALL, rows_of

DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")
NAMES = [*kept.KEPT, "top_products", "history_category_trend", "order_items"]


def deliveries(spark):
    """Three days: most of the tables; the rest with changes to the first day's; some of the second's."""
    whole = testtables.read_inputs(spark, SMALL)
    key = F.col("order_id").cast("long")
    first, second = key % 3 != 0, key % 3 == 0
    reviews = whole.order_reviews
    changed = whole.orders.filter(first & (key % 10 == 1)).withColumns(
        {"order_status": F.lit("lost"), "order_delivered_customer_date": F.lit(None).cast("timestamp_ntz")}
    )
    better = reviews.filter(first & (key % 8 == 1)).withColumns(
        {
            "review_score": F.lit(5),
            "review_comment_message": F.concat(F.coalesce("review_comment_message", F.lit("")), F.lit(" quite good after all")),
        }
    )
    late = F.col("customer_id").cast("long") % 9 == 0
    products = whole.products.filter("cast(product_id as long) % 11 = 0")
    empty = {name: getattr(whole, name).limit(0) for name in INPUTS}
    return [
        Inputs(
            orders=whole.orders.filter(first),
            order_items=whole.order_items.filter(first),
            order_payments=whole.order_payments.filter(first),
            order_reviews=reviews.filter(first & (key % 5 != 2)),
            customers=whole.customers.filter(~late),
            products=whole.products,
            sellers=whole.sellers.filter("cast(seller_id as long) > 1"),
            category_translation=whole.category_translation.filter("product_category_name not like 'S%'"),
        ),
        Inputs(
            orders=whole.orders.filter(second).unionByName(changed),
            order_items=whole.order_items.filter(second),
            order_payments=whole.order_payments.filter(second),
            order_reviews=reviews.filter(second).unionByName(better),
            customers=whole.customers,  # all of them again, some for the first time
            products=products.withColumn("product_category_name", F.lit("STANDARD BRUSHED TIN")),
            sellers=whole.sellers.filter("cast(seller_id as long) = 1"),
            category_translation=whole.category_translation,
        ),
        Inputs(
            **empty
            | {
                "order_reviews": reviews.filter(second & (key % 4 == 0)).withColumns(
                    {"review_id": F.concat("review_id", F.lit("-b")), "review_score": F.lit(2),
                     "review_creation_date": F.lit(dt.datetime(2030, 1, 1))}
                ),
                "order_items": whole.order_items.filter(second & (key % 7 == 0)).withColumns(
                    {"order_item_id": F.lit(99), "price": F.lit(12.5)}
                ).dropDuplicates(["order_id"]),
            }
        ),
    ]


def together(days):
    """The inputs of several days in one: a later day's rows of a key push out the earlier ones."""
    tables = {}
    for name, keys in kept.KEYS.items():
        found = getattr(days[0], name)
        for day in days[1:]:
            new = getattr(day, name)
            found = found.join(new.select(*keys).distinct(), list(keys), "left_anti").select(*new.columns).unionByName(new)
        tables[name] = found
    return Inputs(**tables)


@pytest.fixture(scope="module")
def full_mart(tmp_path_factory):
    """A mart on all rows of some days, written once."""
    known = {}

    def build(days):
        if len(days) not in known:
            base, whole = tmp_path_factory.mktemp("whole"), together(days)
            for name in INPUTS:
                getattr(whole, name).write.parquet(f"{base}/{name}")
            spark = whole.orders.sparkSession
            read = {name: spark.read.parquet(f"{base}/{name}") for name in INPUTS}
            known[len(days)] = LiveMart(Inputs(**read), DAYS[len(days) - 1], catalogue.REPEATABLE)
        return known[len(days)]

    return build


def same_tables(store, full, names=NAMES):
    mart = kept.KeptMart(store)
    for name in names:
        got, want = mart.table(name), full.table(name)
        columns = sorted(want.columns)
        assert sorted(got.columns) == columns, name
        assert rows_of(got, *columns) == rows_of(want, *columns), name


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """(store, deliveries) with the first two days."""
    store = kept.Store(spark, str(tmp_path_factory.mktemp("kept")), catalogue.REPEATABLE)
    days = deliveries(spark)
    for day, delivery in zip(DAYS[:2], days, strict=False):
        store.refresh(delivery, day)
    return store, days


def test_two_days_equal_a_full_run(run, full_mart):
    store, days = run
    same_tables(store, full_mart(days[:2]))


def test_a_day_that_is_run_again_replaces_itself(run, full_mart):
    store, days = run
    before = store.days()
    store.refresh(days[1], DAYS[1])
    assert list(store.days()) == list(before) and store.days() != before
    same_tables(store, full_mart(days[:2]), ["category_summary", "customer_loyalty_rfm", "tfidf_review_keywords"])
    with pytest.raises(ValueError, match="comes before"):
        store.refresh(days[0], DAYS[0])


def test_third_day_reads_its_orders_only(run, full_mart):
    store, days = run
    store.compact()
    assert len(store.state_folders()) == 1
    store.refresh(days[2], DAYS[2])
    folders = store.days()
    assert len(store.state_folders()) == 2  # folded days and the new one
    same_tables(store, full_mart(days))

    touched = store.touched([folders[DAYS[2]]])
    assert 0 < touched.count() < 0.5 * store.touched([folders[DAYS[1]]]).count()
    # all touched orders came on the second day, so the first one's folder stays closed
    earlier = {day: folders[day] for day in DAYS[:2]}
    assert store.days_of(touched, earlier) == [folders[DAYS[1]]]
    again = store._touched_inputs(touched, store.days_of(touched, earlier), list(earlier.values()))
    for name in kept.OF_ORDERS:
        read = [path for path in getattr(again, name).inputFiles() if "/inputs/" in path]
        assert read and all(folders[DAYS[1]] in path for path in read), name
    # what the day adds is no more than its orders have
    added = store.read("sums/customer_loyalty_rfm-1", [folders[DAYS[2]]])
    assert added.count() <= 2 * touched.count()


def test_an_aborted_run_is_not_seen(run, spark, monkeypatch):
    store, days = run
    before, folders = store.days(), store.state_folders()
    monkeypatch.setitem(store.builders, "payment_analysis", lambda mart: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.refresh(days[2], "2024-01-04")
    assert store.days() == before and store.state_folders() == folders


def test_dashboards_read_kept_tables(run, full_mart):
    store, days = run
    mart, full = kept.KeptMart(store), full_mart(days[: len(store.days())])
    for name in ("q1_1", "q2_7", "q3_4", "q4_1", "q5_1", "q6_5", "q7_6"):
        columns = sorted(dashboards.QUERIES[name](full).columns)
        assert rows_of(dashboards.QUERIES[name](mart), *columns) == rows_of(dashboards.QUERIES[name](full), *columns), name


def test_nothing_kept(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        kept.KeptMart(kept.Store(spark, str(tmp_path))).table("category_summary")


def test_orders_and_keys_without_a_name(spark, tmp_path, inputs_of):
    item = {"order_item_id": 1, "product_id": "p", "seller_id": "s", "price": 1.0, "freight_value": 0.5}
    one = inputs_of(
        orders=[{"order_id": "a", "customer_id": "c"}],
        order_items=[{"order_id": None, **item}, {"order_id": "a", **item}],
        customers=[{"customer_id": "c", "customer_unique_id": "u"}],
    )
    two = inputs_of(
        order_items=[{"order_id": None, **item, "price": 3.0}],
        products=[{"product_id": "p", "product_category_name": None}],
    )
    store = kept.Store(spark, str(tmp_path), catalogue.REPEATABLE)
    store.refresh(one, DAYS[0])
    store.refresh(two, DAYS[1])
    assert rows_of(kept.KeptMart(store).table("category_summary"), "total_orders", "total_revenue", "total_items") == [(2, 4.0, 2)]
    assert rows_of(kept.KeptMart(store).table("daily_summary"), "total_orders", "total_revenue") == [(2, 4.0)]


def test_texts_are_stored_once_and_facts_have_their_digest(spark, tmp_path, inputs_of):
    item = {"order_item_id": 1, "product_id": "p", "seller_id": "s", "price": 1.0, "freight_value": 0.5}
    day = inputs_of(
        order_items=[{"order_id": str(i % 4), **item, "order_item_id": i} for i in range(12)],
        order_reviews=[
            {"review_id": str(i), "order_id": str(i), "review_score": 1, "review_comment_message": text}
            for i, text in enumerate(["quebrado quebrado", "quebrado quebrado", None, "atrasado"])
        ],
    )
    store = kept.Store(spark, str(tmp_path), tables=("top_bad_review_words",))
    store.refresh(day, DAYS[0])
    folders = list(store.days().values())
    texts = rows_of(store.read("texts", folders), "review_comment_message")
    assert texts == [("atrasado",), ("quebrado quebrado",)]
    stored = store.facts(folders).select("review_comment_message").distinct().collect()
    assert sorted(len(row[0] or "") for row in stored) == [0, 64, 64]
    mart = kept.KeptMart(store)
    assert rows_of(mart.table("top_bad_review_words")) == [("atrasado", 3), ("quebrado", 12)]
    assert {row[0] for row in rows_of(mart.raw_items("review_comment_message"))} == {None, "atrasado", "quebrado quebrado"}
    assert {row[0] for row in rows_of(mart.orders("review_comment_message"), "review_comment_message")} == {MISSING, "atrasado", "quebrado quebrado"}


def test_stored_keys_are_not_sent_by_the_size_of_their_file(spark, tmp_path):
    """They take many times as much as rows in memory."""
    store = kept.Store(spark, str(tmp_path))
    ids = spark.range(400_000).select(F.xxhash64("id").cast("string").alias("order_id"))
    touched = store.write(ids, "day=1/run=a", "touched")
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert size < 10 << 20  # what Spark would send
    joined = kept._only(spark.range(5).select(F.col("id").cast("string").alias("order_id")), touched, "order_id")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().sparkPlan().toString()


def test_newest_of_key_keeps_missing_keys_and_repeated_rows(frame):
    rows = frame(
        "a string, b int, _day string, v int",
        [("x", 1, "1", 1), ("x", 1, "2", 2), ("x", 1, "2", 3), ("x", None, "1", 4), (None, 1, "1", 5), (None, 1, "3", 6)],
    )
    found = kept.newest_of_key(rows, ["a", "b"])
    assert found.columns == rows.columns
    assert rows_of(found, "v") == [(2,), (3,), (4,), (6,)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # the rows are shuffled once
