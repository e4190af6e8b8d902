"""Queries over rows that were written first: CSV files and tables kept by partial sums.

The test tables are written to the shared folder in the form that a source reads, and
come back through that source. Kept tables are delivered in two days, the first of which
has older versions of some orders and lacks some reviews and customers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.operators import whatif
from cartpulse.operators.fact import Inputs
from cartpulse.operators.imputation import timestamps_to_text
from cartpulse.plans import kept
from cartpulse.plans.mart import LiveMart, Mart
from cartpulse.sources import csvfiles, scratch, testtables

DAYS = ("2024-01-30", "2024-01-31")
RunQuery = Callable[[SparkSession, str], DataFrame]
Builders = dict[str, Callable[[Mart], DataFrame]]


def _through_csv(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    folder = scratch.new_folder(spark, "csv")
    rows = timestamps_to_text(getattr(testtables.read_inputs(spark, sf_dir), name))
    csvfiles.write_csv(rows, f"{folder}/{name}.csv")
    return getattr(csvfiles.read_inputs(spark, folder), name)


def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from CSV files, their dates parsed."""
    return timestamps_to_text(_through_csv(spark, sf_dir, "orders"))


def csv_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_csv(spark, sf_dir, "order_items")


def csv_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews from CSV files with free text over several lines, the texts by their digest."""
    rows = timestamps_to_text(_through_csv(spark, sf_dir, "order_reviews"))
    text = F.col("review_comment_message")
    return rows.select(
        "review_id",
        "order_id",
        "review_score",
        "review_creation_date",
        F.md5(text.cast("binary")).alias("text_md5"),
        F.length(text).alias("text_length"),
    )


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = LiveMart(testtables.read_inputs(spark, sf_dir), DAYS[1])
    return whatif.prepare(mart.items("review_score", *whatif.SOURCES))


def csv_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scenario table, exported and read back."""
    folder = scratch.new_folder(spark, "csv")
    csvfiles.write_csv(whatif.rule_summary(_prepared(spark, sf_dir)), folder)
    return csvfiles.read_scenarios(spark, folder).drop("description", "solution_recommendation")


def csv_utf16_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A what-if sample in UTF-16, how many rows of each score and what they add up to."""
    folder = scratch.new_folder(spark, "csv")
    csvfiles.write_csv(_prepared(spark, sf_dir).select("review_score", *whatif.SOURCES), folder, "UTF-16")
    sample = csvfiles.read_sample(spark, folder)

    def units(name: str, per: float) -> Column:
        return F.sum(F.rint(F.col(name) * per).cast("long"))

    return sample.groupBy("review_score").agg(
        F.count("*").alias("sampled"),
        units("delivery_delay_days", 86_400.0).alias("delay_seconds"),
        units("shipping_duration_days", 86_400.0).alias("duration_seconds"),
        units("freight_value", 10_000.0).alias("freight_units"),
        units("price", 10_000.0).alias("price_units"),
        F.count("product_weight_g").alias("weighed"),
    )


def two_deliveries(whole: Inputs) -> list[Inputs]:
    """What adds up to ``whole``: a first day that lacks and outdates some of it, and the rest."""
    key = F.col("order_id").cast("long")
    first = key % 4 != 0
    outdated = first & (key % 5 == 1)
    late_review = first & (key % 6 == 1)
    late_customer = F.col("customer_id").cast("long") % 7 == 0
    unknown = F.lit(None).cast("timestamp_ntz")
    older = whole.orders.withColumns(
        {
            name: F.when(outdated, then).otherwise(F.col(name)).alias(name)
            for name, then in (
                ("order_status", F.lit("created")),
                ("order_delivered_customer_date", unknown),
            )
        }
    )
    dimensions = {
        "products": whole.products,
        "sellers": whole.sellers,
        "category_translation": whole.category_translation,
    }
    return [
        Inputs(
            orders=older.filter(first),
            order_items=whole.order_items.filter(first),
            order_payments=whole.order_payments.filter(first),
            order_reviews=whole.order_reviews.filter(first & ~late_review),
            customers=whole.customers.filter(~late_customer),
            **dimensions,
        ),
        Inputs(
            orders=whole.orders.filter(~first | outdated),
            order_items=whole.order_items.filter(~first),
            order_payments=whole.order_payments.filter(~first),
            order_reviews=whole.order_reviews.filter(~first | late_review),
            customers=whole.customers.filter(late_customer),
            **{name: rows.limit(0) for name, rows in dimensions.items()},
        ),
    ]


def _kept(name: str, builders: Builders) -> RunQuery:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = kept.Store(spark, scratch.new_folder(spark, "kept"), builders, (name,))
        whole = testtables.read_inputs(spark, sf_dir)
        for day, delivery in zip(DAYS, two_deliveries(whole), strict=True):
            store.refresh(delivery, day)
        return kept.KeptMart(store).table(name)

    return run


def queries(builders: Builders) -> dict[str, RunQuery]:
    found = {
        "source_csv_orders": csv_orders,
        "source_csv_items": csv_items,
        "source_csv_reviews": csv_reviews,
        "source_csv_scenarios": csv_scenarios,
        "source_utf16_sample": csv_utf16_sample,
    }
    names = ("category_summary", "customer_loyalty_rfm", "geographic_analysis", "tfidf_review_keywords")
    return found | {f"kept_{name}": _kept(name, builders) for name in names}
