from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartpulse.operators import fact
from cartpulse.operators.imputation import audit, impute
from cartpulse.schemas import FACT, INPUTS
from cartpulse.sources import testtables
from tests.conftest import SMALL, rows_of, ts


def order(key, **values):
    base = {
        "order_id": key,
        "customer_id": "c1",
        "order_status": "delivered",
        "order_purchase_timestamp": ts("2018-01-01 10:00:00"),
        "order_approved_at": ts("2018-01-01 22:00:00"),
        "order_delivered_carrier_date": ts("2018-01-02 10:00:00"),
        "order_delivered_customer_date": ts("2018-01-05 10:00:00"),
        "order_estimated_delivery_date": ts("2018-01-04 10:00:00"),
    }
    return base | values


def item(key, number=1, **values):
    base = {
        "order_id": key,
        "order_item_id": number,
        "product_id": "p1",
        "seller_id": "s1",
        "price": 10.0,
        "freight_value": 2.5,
    }
    return base | values


@pytest.fixture
def shop(inputs_of):
    return inputs_of(
        orders=[
            order("o1"),
            order("o2", order_delivered_customer_date=None, customer_id="c2"),
            order("o3", order_purchase_timestamp=None, customer_id=None),
        ],
        order_items=[item("o1", 1), item("o1", 2, price=5.0), item("o2"), item("o3"), item("o9")],
        products=[{"product_id": "p1", "product_category_name": "casa", "product_weight_g": 900.0}],
        customers=[
            {"customer_id": "c1", "customer_unique_id": "u1", "customer_state": "SP"},
            {"customer_id": "c2", "customer_unique_id": "u2", "customer_state": "RJ"},
        ],
        sellers=[{"seller_id": "s1", "seller_state": "SP"}],
        order_payments=[
            {"order_id": "o1", "payment_sequential": 2, "payment_type": "voucher",
             "payment_installments": 1, "payment_value": 3.3},
            {"order_id": "o1", "payment_sequential": 1, "payment_type": None,
             "payment_installments": 4, "payment_value": 10.1},
            {"order_id": "o1", "payment_sequential": 3, "payment_type": "boleto",
             "payment_installments": 2, "payment_value": None},
            {"order_id": "o9", "payment_sequential": 1, "payment_type": "boleto",
             "payment_installments": 1, "payment_value": 7.0},
        ],
        order_reviews=[
            {"review_id": "r1", "order_id": "o1", "review_score": 5,
             "review_creation_date": ts("2018-02-01 00:00:00")},
            {"review_id": "r2", "order_id": "o1", "review_score": 1,
             "review_creation_date": ts("2018-03-01 00:00:00")},
            {"review_id": "r3", "order_id": "o2", "review_score": 2,
             "review_creation_date": ts("2018-03-01 00:00:00")},
            {"review_id": "r4", "order_id": "o2", "review_score": 4, "review_creation_date": None},
            {"review_id": "r5", "order_id": "o3", "review_score": 1,
             "review_creation_date": ts("2018-03-01 00:00:00")},
            {"review_id": "r6", "order_id": "o3", "review_score": 3,
             "review_creation_date": ts("2018-03-01 00:00:00")},
        ],
        category_translation=[
            {"product_category_name": "casa", "product_category_name_english": "home"}
        ],
    )


def test_payments_take_first_known_type_most_installments_and_sum(shop):
    found = rows_of(fact.payments_per_order(shop.order_payments))
    assert found == [("o1", "voucher", 4, 13.4), ("o9", "boleto", 1, 7.0)]


def test_latest_review_wins_undated_is_newest_ties_by_id(shop):
    found = dict(rows_of(fact.latest_reviews(shop.order_reviews), "order_id", "review_score"))
    assert found == {"o1": 1, "o2": 4, "o3": 3}


def test_fact_has_the_contract_and_one_row_per_item(shop):
    df = fact.item_fact(shop, ingested_date="2018-06-01")
    assert df.columns == FACT.fieldNames()
    assert df.count() == 5


def test_measures_of_an_order(shop):
    df = fact.item_fact(shop).filter("order_id = 'o1' and order_item_id = 1")
    row = df.first()
    assert (row.delivery_delay_days, row.shipping_duration_days) == (1.0, 3.0)
    assert (row.approval_delay_hours, row.is_late_delivery) == (12.0, 1)
    assert (row.order_hour_of_day, row.order_day_of_week) == (10, 0)  # a Monday
    assert row.total_item_value == 12.5


def test_undelivered_order_is_not_late_and_keeps_null_delay(shop):
    row = fact.item_fact(shop).filter("order_id = 'o2'").first()
    assert row.delivery_delay_days is None and row.is_late_delivery == 0


def test_item_without_order_keeps_its_payment(shop):
    row = impute(fact.item_fact(shop)).filter("order_id = 'o9'").first()
    assert row.payment_type == "boleto" and row.payment_value == 7.0
    assert (row.order_status, row.customer_state, row.is_late_delivery) == ("missing", "missing", 0)
    assert row.review_score is None and row.order_purchase_timestamp is None


def test_missing_hour_and_weekday_become_zero(shop):
    row = impute(fact.item_fact(shop)).filter("order_id = 'o3'").first()
    assert (row.order_hour_of_day, row.order_day_of_week, row.customer_unique_id) == (0, 0, "missing")


def test_unneeded_joins_are_left_out(shop):
    plan = fact.item_fact(shop, ["order_id", "price"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_same_values_whatever_columns_are_asked_for(shop):
    wide = fact.item_fact(shop)
    for name in ("review_score", "payment_value", "customer_state", "seller_state", "order_status"):
        narrow = fact.item_fact(shop, ["order_id", "order_item_id", name])
        assert rows_of(narrow) == rows_of(wide, *narrow.columns)


def test_lines_and_orders_add_up(shop):
    orders = fact.clean_orders(shop, ["review_score"])
    assert rows_of(orders, "order_id", "n_items", "price_units", "review_score") == [
        ("o1", 2, 150_000, 1), ("o2", 1, 100_000, 4), ("o3", 1, 100_000, 3), ("o9", 1, 100_000, None),
    ]
    lines = fact.clean_lines(
        shop, ["seller_id"], ["order_status"], {"dear": F.col("price") > 7}
    ).filter("order_id = 'o1'")
    assert rows_of(lines, "seller_id", "dear", "n_items", "order_status") == [
        ("s1", False, 1, "delivered"), ("s1", True, 1, "delivered"),
    ]


def test_audit_counts_null_and_sentinel(frame):
    df = frame("order_id string, price double", [("missing", 1.0), (None, None), ("a", 2.0)])
    found = rows_of(audit(df, ["order_id", "price"], "2018-01-01"))
    assert found == [
        ("2018-01-01", "order_id", 3, 2, 66.67),
        ("2018-01-01", "price", 3, 1, 33.33),
    ]


def test_audit_of_no_rows(frame):
    found = rows_of(audit(frame("price double", []), ["price"], "2018-01-01"))
    assert found == [("2018-01-01", "price", 0, 0, 0.0)]


def test_imputation_fills_by_kind_and_leaves_the_exempt(frame):
    df = frame(
        "seller_city string, payment_installments int, payment_value double, review_score int,"
        " delivery_delay_days double",
        [(None, None, None, None, None)],
    )
    assert rows_of(impute(df)) == [("missing", 0, 0.0, None, None)]


def test_inputs_reject_other_tables():
    with pytest.raises(ValueError, match="orders"):
        fact.Inputs(order=None)


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def tiny_skew_limits(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW_SETTINGS}
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _with_items(inputs, items):
    tables = {name: getattr(inputs, name) for name in fact.INPUTS}
    return fact.Inputs(**(tables | {"order_items": items.repartition(8)}))


def _hot(column: str):
    return F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(column)


def _splits(df) -> bool:
    return "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_and_complete(spark, inputs_of, tiny_skew_limits):
    """A third of all items in one order: the join still gives every item."""
    rows = spark.range(60_000).select(
        _hot("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.lit("p1").alias("product_id"),
        F.lit("s1").alias("seller_id"),
        F.rand(7).alias("price"),
        F.lit(1.0).alias("freight_value"),
    )
    shop = inputs_of(
        orders=[order("hot", order_status="shipped")],
        order_reviews=[{"review_id": "r", "order_id": "hot", "review_score": 2}],
    )
    joined = fact.item_fact(
        _with_items(shop, rows),
        ["order_id", "order_item_id", "price", "order_status", "review_score"],
    )
    found = joined.groupBy("order_status").agg(
        F.count("*"), F.count_if(F.col("price") < 2), F.max("review_score")
    )
    assert rows_of(found) == [("shipped", 20_000, 20_000, 2), (None, 40_000, 40_000, None)]
    assert _splits(found)


@pytest.mark.parametrize("hot", ["product_id", "seller_id"])
def test_hot_product_or_seller_is_split_and_complete(spark, inputs_of, tiny_skew_limits, hot):
    ids = {name: F.lit("x").alias(name) for name in ("product_id", "seller_id")} | {hot: _hot(hot)}
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        *ids.values(),
        F.rand(7).alias("price"),
        F.lit(1.0).alias("freight_value"),
    )
    shop = inputs_of(
        products=[{"product_id": "hot", "product_category_name": "casa"}],
        sellers=[{"seller_id": "hot", "seller_state": "casa"}],
    )
    key = {"product_id": "product_category_name", "seller_id": "seller_state"}[hot]
    found = fact.clean_lines(_with_items(shop, rows), [key]).groupBy(key).agg(F.sum("n_items"))
    assert rows_of(found) == [("casa", 20_000), ("missing", 40_000)]
    assert _splits(found)


def test_hot_order_reaches_the_join_as_one_row(spark, inputs_of):
    rows = spark.range(3_000).select(
        F.lit("hot").alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.lit("p1").alias("product_id"),
        F.lit("s1").alias("seller_id"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("freight_value"),
    )
    shop = _with_items(inputs_of(orders=[order("hot")]), rows)
    lines = fact.clean_lines(shop, ["seller_id"], ["order_status"])
    assert rows_of(lines, "seller_id", "n_items", "order_status") == [("s1", 3_000, "delivered")]
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # summed below the join


def test_texts_apart_move_as_ids_until_the_last(spark, inputs_of, monkeypatch):
    tables = {
        "order_items": [{"order_id": f"o{i // 2}", "order_item_id": i, "price": 1.0} for i in range(12)],
        "orders": [{"order_id": f"o{i}", "customer_id": "c"} for i in range(6)],
    }
    whole = inputs_of(**tables)
    texts = spark.createDataFrame([(1, "late"), (2, None), (3, "good")], "text_id bigint, review_comment_message string")
    keys = spark.createDataFrame(
        [("a", "o0", 1, 1), ("b", "o0", 5, 3), ("c", "o1", 2, 2), ("d", "o2", 3, None), ("e", "o3", 4, 9)],
        "review_id string, order_id string, review_score int, text_id bigint",
    ).withColumn("review_creation_date", F.lit(ts("2018-01-01")))
    reviews = keys.join(texts, "text_id", "left").select(*INPUTS["order_reviews"].fieldNames())
    given = {name: getattr(whole, name) for name in INPUTS} | {"order_reviews": reviews}
    inline = fact.Inputs(**given)
    want = rows_of(fact.item_fact(inline, ingested_date="d"))
    lines = rows_of(fact.clean_lines(inline, ["product_id"], ["review_comment_message"]))
    for most in (1 << 20, 0):  # sent to the tasks, or met in a shuffle
        monkeypatch.setattr(fact, "TEXT_BYTES_TO_SEND", most)
        apart = fact.Inputs(**given, review_keys=keys, review_texts=texts)
        assert apart.sends_texts == (most > 0)
        found = fact.item_fact(apart, ingested_date="d")
        assert found.columns == fact.item_fact(inline).columns and rows_of(found) == want
        assert rows_of(fact.clean_lines(apart, ["product_id"], ["review_comment_message"])) == lines
        newest = rows_of(fact.newest_reviews(apart), "order_id", "review_score", "review_comment_message")
        assert newest == rows_of(fact.newest_reviews(inline), "order_id", "review_score", "review_comment_message")
        if most:
            carried = fact.fact_by_text(apart)
            assert "text_id" in carried.columns and "review_comment_message" not in carried.columns
            # texts meet the rows after the last shuffle of these
            plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
            joins = [line for line in plan if "Join LeftOuter" in line]
            assert "text_id" in joins[0] and "rightHint=(strategy=broadcast)" in joins[0]
    with pytest.raises(ValueError, match="together"):
        fact.Inputs(**given, review_keys=keys)


def test_texts_that_are_not_sent_meet_the_items_last(spark, monkeypatch):
    """Joined to the reviews they would go through the shuffles of all orders."""
    monkeypatch.setattr(fact, "TEXT_BYTES_TO_SEND", 0)
    rows = fact.item_fact(testtables.read_inputs(spark, SMALL), ingested_date="d")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    last_join = next(line for line in plan.splitlines() if "Join " in line)
    assert "text_id" in last_join
    sent = testtables.read_inputs(spark, SMALL)
    monkeypatch.undo()
    want = rows_of(fact.item_fact(sent, ingested_date="d"))
    assert rows_of(rows) == want


def test_texts_are_sized_as_they_lie_and_move_once(spark, monkeypatch):
    """No shuffle to tell how long they are, and none with the orders."""
    inputs = testtables.read_inputs(spark, SMALL)
    monkeypatch.setattr(fact, "may_be_sent", lambda *_: pytest.fail("read by id to be sized"))
    assert inputs.sends_texts
    monkeypatch.setattr(fact, "TEXT_BYTES_TO_SEND", 0)
    unsent = testtables.read_inputs(spark, SMALL)
    lines = fact.clean_lines(unsent, ["product_id"], ["review_comment_message", "order_status"])
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "text_id" in next(line for line in plan.splitlines() if "Join " in line)
    rows = fact.fact_by_text(unsent, ingested_date="d")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # with the orders' side, the items only after it
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert "text_id" not in joins[0] and any("text_id" in line for line in joins)
    want = rows_of(fact.item_fact(inputs, ingested_date="d"))
    assert rows_of(rows) == want


def test_measures_made_late_are_those_of_the_orders(inputs_of):
    at = {name: ts(f"2018-01-0{i + 1} 0{i}:30:00") for i, name in enumerate(fact.TIMESTAMPS)}
    inputs = inputs_of(
        orders=[{"order_id": "a", **at}, {"order_id": "b"}],
        order_items=[{"order_id": name, "order_item_id": 1} for name in ("a", "b", "gone", None)],
    )
    made = (*fact.MADE_OF_TIMES, "is_late_delivery")
    alone = fact.item_fact(inputs, ["order_id", *made])
    whole = fact.item_fact(inputs)
    assert rows_of(whole, "order_id", *made) == rows_of(alone, "order_id", *made)
    late = {row.order_id: row.is_late_delivery for row in whole.collect()}
    assert late == {"a": 0, "b": 0, "gone": None, None: None}
