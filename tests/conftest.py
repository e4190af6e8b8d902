from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import SparkSession

from cartpulse.operators.fact import Inputs
from cartpulse.schemas import INPUTS

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("cartpulse-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def frame(spark):
    """``frame("a int, b string", [(1, "x")])``"""

    def build(schema: str, rows: list[tuple]):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def inputs_of(spark):
    """Inputs from lists of dicts per table; what is not given is empty or NULL."""

    def build(**tables: list[dict]) -> Inputs:
        frames = {}
        for name, schema in INPUTS.items():
            rows = [tuple(row.get(f.name) for f in schema) for row in tables.get(name, [])]
            frames[name] = spark.createDataFrame(rows, schema)
        return Inputs(**frames)

    return build


def rows_of(df, *columns):
    """Rows as tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
