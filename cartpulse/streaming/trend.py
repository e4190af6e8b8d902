"""The category trend as a stream: every micro-batch appends its own totals.

An order is counted for a category once, in the batch that first holds an item of both.
Which orders and categories were seen is state of the stream, kept with its checkpoint and
let go ``remember`` after it was first seen. So the batches add up to the totals of all
items, as long as an order's items come within that time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartpulse.functions.measures import MONEY_UNITS, money_units

CATEGORY = "product_category_name_english"
EVERY = "5 minutes"
REMEMBER = "30 days"
BATCH = "batch_id"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
TREND_SCHEMA = (
    f"{CATEGORY} string, total_orders bigint, total_revenue double, avg_review_score double,"
    " score_sum bigint, scored_items bigint,"
    f" batch_time timestamp, ingested_date string, {BATCH} int"
)


def counted_once(items: DataFrame, remember: str = REMEMBER) -> DataFrame:
    """The rows of a stream, and one more for every order and category not seen before.

    ``new_orders`` is 1 on those and 0 on the items themselves. Time is that of arrival, so
    no row is too late to be counted.
    """
    seen = (
        items.select("order_id", CATEGORY, F.current_timestamp().alias("arrived"))
        .withWatermark("arrived", remember)
        .dropDuplicatesWithinWatermark(["order_id", CATEGORY])
        .select(
            CATEGORY,
            F.lit(None).cast("long").alias("price_units"),
            F.lit(None).cast("int").alias("review_score"),
            F.lit(1).alias("new_orders"),
        )
    )
    rows = items.select(
        CATEGORY,
        money_units(F.col("price")).alias("price_units"),
        F.col("review_score").cast("int").alias("review_score"),
        F.lit(0).alias("new_orders"),
    )
    return rows.unionByName(seen)


def category_trend(counted: DataFrame) -> DataFrame:
    """New orders, revenue and score per category of one batch; sums for adding batches up."""
    summed = counted.groupBy(CATEGORY).agg(
        F.sum("new_orders").alias("total_orders"),
        (F.sum("price_units") / F.lit(float(MONEY_UNITS))).alias("total_revenue"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("scored_items"),
    )
    return summed.withColumn(
        "avg_review_score", F.try_divide(F.col("score_sum").cast("double"), F.col("scored_items"))
    )


def trend_totals(batches: DataFrame) -> DataFrame:
    """All batches of ``read_trend`` together: what one batch of all items would give."""
    units = F.sum(money_units(F.col("total_revenue")))
    return batches.groupBy(CATEGORY).agg(
        F.sum("total_orders").alias("total_orders"),
        (units / F.lit(float(MONEY_UNITS))).alias("total_revenue"),
        F.try_divide(F.sum("score_sum").cast("double"), F.sum("scored_items")).alias(
            "avg_review_score"
        ),
    )


def start_trend(
    items: DataFrame,
    target: str,
    checkpoint: str,
    once: bool = False,
    remember: str = REMEMBER,
) -> StreamingQuery:
    """Append the trend of each micro-batch under ``target``.

    A batch owns the folder ``batch_id=<n>`` and overwrites it, so a batch that
    is run again after a failure adds nothing twice: its state is that of the batch
    before it, too. ``once`` works off what is there and stops; otherwise a batch
    starts every five minutes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = category_trend(batch).withColumns(
            {
                "batch_time": F.current_timestamp(),
                "ingested_date": F.current_date().cast("string"),
            }
        )
        stamped.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")

    counted = counted_once(items, remember)
    writer = counted.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    every = {"availableNow": True} if once else {"processingTime": EVERY}
    # a stream keeps the settings it starts with; state is let go by batches that have rows
    settings = items.sparkSession.conf
    usual = settings.get(EMPTY_BATCHES)
    settings.set(EMPTY_BATCHES, "false")
    try:
        return writer.trigger(**every).start()
    finally:
        settings.set(EMPTY_BATCHES, usual)


def read_trend(spark: SparkSession, target: str) -> DataFrame:
    """All batches written so far; a stream without any gives no rows."""
    try:
        return spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], TREND_SCHEMA)
