"""Commit records: which folder holds the rows of a name, written after the rows are.

A record is one JSON row under ``<base>/_commits``. Records are only ever added, so a
reader sees a folder whole or not at all, and the newest record of a name counts.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "name string, folder string, number bigint"


def new_folder(name: str) -> str:
    """A folder below the base that no other run has."""
    return f"{name}/run={uuid.uuid4().hex}"


def _records(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(RECORD).json(f"{base}/_commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD)


def commit(spark: SparkSession, base: str, name: str, folder: str) -> None:
    """Make ``folder`` what is read for ``name``. One writer at a time."""
    last = _records(spark, base).agg(F.max("number")).first()[0] or 0
    record = spark.range(1).select(
        F.lit(name).alias("name"), F.lit(folder).alias("folder"), F.lit(last + 1).alias("number")
    )
    record.coalesce(1).write.mode("append").json(f"{base}/_commits")


def committed(spark: SparkSession, base: str) -> dict[str, str]:
    """Folder of every name, names in order; as many rows as there were runs."""
    newest = _records(spark, base).groupBy("name").agg(F.max_by("folder", "number").alias("folder"))
    return {row["name"]: row["folder"] for row in newest.orderBy("name").collect()}
