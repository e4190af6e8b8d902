"""CSV readers and writers with stated schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartpulse.operators.fact import Inputs
from cartpulse.operators.whatif import check_columns
from cartpulse.schemas import INPUTS, TABLES

# Only files with free text need quoted line breaks; the others stay splittable.
_FREE_TEXT = {"order_reviews"}
# A file with free text is read by one task, so none gets more rows than these.
ROWS_PER_FILE = 50_000
_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
_COUNTS = ("total_orders", "affected_orders", "additional_orders_est")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Typed scan. Columns are matched by the header, not by position.

    The header is read on its own, since a file may hold more columns than the
    schema names, or hold them in another order.
    """
    contract = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    header = (
        spark.read.option("encoding", encoding)
        .option("header", True)
        .option("multiLine", multi_line)
        .csv(path)
        .columns
    )
    kinds = {field.name: field.dataType for field in contract}
    layout = StructType()
    for name in header:
        layout.add(name, kinds.get(name, "string"))
    rows = (
        spark.read.schema(layout)
        .option("header", True)
        .option("enforceSchema", False)  # a file with another header fails, it is not misread
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("timestampNTZFormat", _TIMESTAMP_FORMAT)
        .csv(path)
    )
    known = set(header)
    return rows.select(
        *[
            F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
            for f in contract
        ]
    )


def read_inputs(spark: SparkSession, folder: str, encoding: str = "UTF-8") -> Inputs:
    """The eight CSV inputs of a folder, each opened on first use."""

    def reader(name: str):
        return lambda: read_csv(
            spark, f"{folder}/{name}.csv", INPUTS[name], encoding, name in _FREE_TEXT
        )

    return Inputs(**{name: reader(name) for name in INPUTS})


def read_sample(spark: SparkSession, path: str, encoding: str = "UTF-16") -> DataFrame:
    """A what-if sample; fails with the list of columns that are missing."""
    rows = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("multiLine", True)
        .csv(path)
    )
    check_columns(rows)
    return rows.select(
        F.col("review_score").cast("double").cast("int").alias("review_score"),
        *[
            F.col(name).cast("double").alias(name)
            for name in (
                "delivery_delay_days",
                "shipping_duration_days",
                "freight_value",
                "price",
                "product_weight_g",
            )
        ],
    )


def read_scenarios(spark: SparkSession, path: str) -> DataFrame:
    """An exported scenario table; missing counts become 0."""
    rows = read_csv(spark, path, TABLES["analytics.simulation_scenarios"])
    return rows.na.fill(0, list(_COUNTS))


def read_feature_impact(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TABLES["analytics.simulation_feature_impact"])


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """With a header; texts keep their white space, quotes are doubled."""
    (
        df.write.mode("overwrite")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
