"""Writing warehouse tables: contract cast, overwrite, append, parts that a repeated run replaces."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.schemas import TABLES

DATABASES = ("orders_db", "analytics")
BATCH_ROWS = 10_000


def create_databases(spark: SparkSession) -> None:
    for name in DATABASES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_tables(spark: SparkSession) -> None:
    """Empty tables by contract, where they do not exist yet."""
    create_databases(spark)
    for name, contract in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in contract)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def conform(df: DataFrame, table: str) -> DataFrame:
    """The columns of the contract, in its order and types; NaN becomes NULL."""
    kinds = dict(df.dtypes)

    def column(name: str, target):
        source = F.col(name)
        if kinds[name] in ("double", "float"):
            source = F.when(~F.isnan(name), source)
        return source.cast(target).alias(name)

    return df.select(*[column(field.name, field.dataType) for field in TABLES[table]])


def overwrite(df: DataFrame, table: str, buckets: int | None = None) -> None:
    """Replace the rows of a table, also by none at all.

    With ``buckets`` the table is bucketed by order: counting orders and joining
    on the order then need no shuffle. The rows are hashed first so that each
    task writes one bucket.
    """
    rows = conform(df, table)
    if buckets is None:
        rows.write.mode("overwrite").format("parquet").saveAsTable(table)
        return
    (
        rows.repartition(buckets, "order_id")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "order_id")
        .sortBy("order_id")
        .saveAsTable(table)
    )


def append(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    writer = conform(df, table).write.mode("append").format("parquet")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(table)


def replace_part(df: DataFrame, table: str, **part: str) -> None:
    """Append the rows of one run; a run that is repeated replaces its own, also by none.

    ``part`` names the run by values of columns of the contract: the table is partitioned by
    them, in that order, and the rows get these values. Runs that share the first of
    them are told apart by the next.
    """
    spark, contract = df.sparkSession, TABLES[table]
    kinds = {f.name: f.dataType.simpleString() for f in contract}
    rest = [f.name for f in contract if f.name not in part]
    valued = {name: F.lit(value).cast(kinds[name]) for name, value in part.items()}
    rows = conform(df.withColumns(valued), table).select(*rest, *part)
    if not spark.catalog.tableExists(table):
        rows.limit(0).write.format("parquet").partitionBy(*part).saveAsTable(table)
    source = f"part_{uuid.uuid4().hex}"
    rows.drop(*part).createOrReplaceTempView(source)
    typed = {name: "TIMESTAMP " if kinds[name] == "timestamp" else "" for name in part}
    values = ", ".join(f"{name} = {typed[name]}'{value}'" for name, value in part.items())
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({values}) SELECT * FROM {source}")
    finally:
        spark.catalog.dropTempView(source)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Send a table to a database, in batches; the rows are replaced."""
    df.write.mode("overwrite").option("truncate", True).option("batchsize", BATCH_ROWS).jdbc(
        url, table, properties=properties
    )
