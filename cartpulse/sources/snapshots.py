"""Parquet snapshots of the fact: a folder per run, a commit record once it is whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.sources import commits

SNAPSHOT = "snapshot"


def write_snapshot(
    fact: DataFrame,
    base: str,
    snapshot: str,
    files: int | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Write one snapshot; a repeated run takes the place of its own snapshot only.

    The rows are clustered by order, so per-order work on the snapshot finds the
    items of an order in one file. ``finish`` adds to the clustered rows what need not
    be shuffled and sorted with them. Until the record is written readers keep to what
    was there before; the files of a run that was replaced stay.
    """
    rows = fact.repartition("order_id") if files is None else fact.repartition(files, "order_id")
    folder = commits.new_folder(f"{SNAPSHOT}={snapshot}")
    rows = rows.sortWithinPartitions("order_id", "order_item_id")
    finish(rows).write.option("compression", "zstd").parquet(f"{base}/{folder}")
    commits.commit(fact.sparkSession, base, snapshot, folder)


def read_latest_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """The committed snapshot with the greatest name; its folder is the only one opened."""
    folders = commits.committed(spark, base)
    if not folders:
        raise FileNotFoundError(f"no snapshot in {base}")
    return spark.read.parquet(f"{base}/{folders[max(folders)]}")


def read_newest_file(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the Parquet file that was modified last."""
    rows = _open(spark.read, folder)
    changed = F.col("_metadata.file_modification_time")
    newest = rows.select(changed.alias("t")).agg(F.max("t").alias("t")).first()["t"]
    if newest is None:
        raise FileNotFoundError(f"no Parquet file in {folder}")
    return rows.filter(changed == F.lit(newest))


def _open(reader, path: str) -> DataFrame:
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no Parquet file in {path}") from error
