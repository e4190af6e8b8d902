"""Every registered query with a DuckDB twin gives the same rows, to the last digit."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from tests.conftest import SMALL
from verification.check import difference, duck

TWINS = registered.oracle_sql()
QUERIES = registered.queries()


@pytest.fixture(scope="module")
def con():
    opened = duck(SMALL)
    yield opened
    opened.close()


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, con, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert difference(got, con.execute(TWINS[name]).df()) == ""


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_fifty_dashboard_queries():
    tabs = [name for name in QUERIES if name.startswith("q")]
    assert len(tabs) == 50


def test_entry(spark):
    assert registered.entry(spark).columns == ["category", "total_orders", "revenue", "avg_review"]
