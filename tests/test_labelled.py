from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartpulse.operators import models, whatif
from cartpulse.plans import catalogue, tables
from tests.conftest import SMALL, rows_of


@pytest.mark.parametrize("columns", [(), ("order_item_id",)])
@pytest.mark.parametrize("count", [50, 3_000])
def test_first_labelled_holds_the_sample_of_all_rows(spark, columns, count):
    mart = catalogue.mart_of(spark, SMALL)
    wanted = (*columns, "review_score", *whatif.SOURCES)
    every = mart.items(*wanted)
    few = tables.first_labelled(mart, *wanted, count=count)
    assert few.columns == every.columns
    place = models.sample_place(every.columns)

    def sample(rows):
        # an order's items have one place where its id is the whole key
        reviewed = rows.filter("review_score is not null").withColumn("place", place)
        last = reviewed.orderBy("place").limit(count).agg(F.max("place")).first()[0]
        return rows_of(reviewed.filter(F.col("place") <= last))

    assert sample(few) == sample(every)
    if count == 50:
        assert few.count() < every.count() / 4


def test_too_few_reviews_widen_the_part_that_is_joined(spark, inputs_of):
    orders = [f"o{n}" for n in range(400)]
    items = [{"order_id": o, "order_item_id": n} for o in orders for n in (1, 2)]
    # one order in twenty is reviewed; an item without an order is not
    reviews = [{"review_id": o, "order_id": o, "review_score": 3} for o in orders[::20]]
    inputs = inputs_of(order_items=[*items, {"order_item_id": 1}], order_reviews=reviews)
    found = tables.first_labelled(tables.LiveMart(inputs), "review_score", count=10)
    assert found.filter("review_score is not null").count() >= 10
    every = tables.first_labelled(tables.LiveMart(inputs), "review_score", count=1_000)
    assert every.count() == 801
