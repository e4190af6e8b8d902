"""One batch run: inputs to snapshot, snapshot to warehouse tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from cartpulse.operators.fact import Inputs, fact_by_text, with_texts
from cartpulse.operators.imputation import impute, timestamps_to_text
from cartpulse.plans.mart import StoredMart
from cartpulse.plans.tables import BUILDERS
from cartpulse.schemas import FACT, TABLES
from cartpulse.sources import snapshots, warehouse

FACT_TABLE = "orders_db.order_items"
TREND = "history_category_trend"
# Tables that need a fitted model.
MODELLED = ("feature_importances", "simulation_scenarios", "simulation_feature_impact")


def run(
    spark: SparkSession,
    inputs: Inputs,
    snapshot_base: str,
    run_date: str | None = None,
    buckets: int | None = None,
    with_models: bool = True,
    batch_time: str | None = None,
) -> StoredMart:
    """Write every table and return the mart that reads them.

    The joins run once, for the snapshot. Everything after it reads stored rows,
    so a lost executor costs the tasks at hand and never the joins. A run that is
    repeated with the same date replaces its own snapshot and all tables. The trend
    keeps the rows of other runs: a run is told by its date and ``batch_time`` (the
    scheduled time; the start of the day unless given), and replaces only its own.
    """
    day = run_date or dt.date.today().isoformat()
    at = dt.datetime.fromisoformat(batch_time or day).isoformat(" ", "seconds")
    fact_snapshot(inputs, snapshot_base, day, buckets)
    raw = snapshots.read_latest_snapshot(spark, snapshot_base)

    warehouse.create_databases(spark)
    clean = timestamps_to_text(impute(raw))
    warehouse.overwrite(clean, FACT_TABLE, buckets)

    mart = StoredMart(spark, day, raw)
    for full_name in _in_order():
        name = full_name.split(".")[1]
        if full_name == FACT_TABLE or (name in MODELLED and not with_models):
            continue
        rows = BUILDERS[name](mart)
        if name == TREND:
            warehouse.replace_part(rows, full_name, ingested_date=day, batch_time=at)
        else:
            warehouse.overwrite(rows, full_name)
    return mart


def fact_snapshot(inputs: Inputs, base: str, day: str, files: int | None = None) -> None:
    """Write the fact as a snapshot; texts that can be sent join the rows once these are sorted."""

    def finish(rows: DataFrame) -> DataFrame:
        return with_texts(rows, inputs).select(*FACT.fieldNames())

    rows = fact_by_text(inputs, ingested_date=day)
    snapshots.write_snapshot(rows, base, day, files, finish)


def _in_order() -> list[str]:
    """Table names with ``category_summary`` ahead of what is read off it."""
    first = "orders_db.category_summary"
    return [first, *[name for name in TABLES if name != first]]
