"""All registered queries by name, over the generated test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.functions import text as T
from cartpulse.operators import fact, keywords, models, whatif
from cartpulse.operators.imputation import timestamps_to_text
from cartpulse.plans import dashboards, job, roundtrips, tables
from cartpulse.plans.mart import LiveMart, Mart
from cartpulse.schemas import FACT
from cartpulse.sources import scratch, snapshots, testtables
from cartpulse.streaming import trend

RUN_DATE = "2024-01-31"
RunQuery = Callable[[SparkSession, str], DataFrame]


def _prepared(mart: Mart) -> DataFrame:
    return whatif.prepare(mart.items("order_item_id", "review_score", *whatif.SOURCES))


def _trend_at_run_date(mart: Mart) -> DataFrame:
    return tables.history_category_trend(mart, F.lit(f"{RUN_DATE} 00:00:00").cast("timestamp_ntz"))


# Tables whose twin in plain SQL can hold no fitted model and no clock.
REPEATABLE = {
    "customer_loyalty_rfm": lambda mart: timestamps_to_text(tables.loyalty_rfm(mart)),
    "simulation_scenarios": lambda mart: whatif.rule_summary(_prepared(mart)),
    "history_category_trend": _trend_at_run_date,
}


def mart_of(spark: SparkSession, sf_dir: str, repeatable: bool = True) -> LiveMart:
    inputs = testtables.read_inputs(spark, sf_dir)
    return LiveMart(inputs, RUN_DATE, REPEATABLE if repeatable else None)


def _on_mart(build: Callable[[LiveMart], DataFrame], repeatable: bool = True) -> RunQuery:
    return lambda spark, sf_dir: build(mart_of(spark, sf_dir, repeatable))


# ------------------------------------------------------------------ inputs and fact


def _raw_fact(mart: LiveMart) -> DataFrame:
    return timestamps_to_text(mart.raw_items(*FACT.fieldNames()))


def _products(mart: LiveMart) -> DataFrame:
    return fact.products_in_english(mart.inputs.products, mart.inputs.category_translation)


def _order_measures(mart: LiveMart) -> DataFrame:
    return timestamps_to_text(fact.with_order_measures(mart.inputs.orders))


def _order_grain(mart: LiveMart) -> DataFrame:
    columns = (*fact.CUSTOMER_FIELDS, *fact.PAYMENT_FIELDS, "review_score", "is_late_delivery")
    return mart.orders(*columns)


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the fact as a snapshot and read the newest one back."""
    base = scratch.new_folder(spark, "snapshot")
    job.fact_snapshot(mart_of(spark, sf_dir).inputs, base, RUN_DATE)
    return timestamps_to_text(snapshots.read_latest_snapshot(spark, base))


# ------------------------------------------------------------------ texts


def _tokens(mart: LiveMart) -> DataFrame:
    texts = tables.review_texts(mart).select("order_id", "review_comment_message")
    return T.add_keyword_tokens(texts, "review_comment_message", "tokens").select(
        "order_id", F.array_join("tokens", " ").alias("tokens")
    )


def _term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = keywords.term_counts(testtables.labelled_corpus(spark, sf_dir))
    return counts.filter(F.col("word").isNotNull()).select(
        "word", "freq_negative", "freq_neutral", "freq_positive", "doc_freq"
    )


def _corpus_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_scores(testtables.labelled_corpus(spark, sf_dir))


def _corpus_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.top_keywords(testtables.labelled_corpus(spark, sf_dir))


def _complaints(mart: LiveMart) -> DataFrame:
    return keywords.complaint_causes(keywords.review_corpus(tables.review_texts(mart)))


def _notebook_words(mart: LiveMart) -> DataFrame:
    return keywords.squeezed_word_counts(mart.inputs.order_reviews)


def _cleaned_texts(mart: LiveMart) -> DataFrame:
    cleaned = keywords.cleaned_reviews(mart.inputs)
    return cleaned.select("review_id", "review_score", "cleaned_text")


# ------------------------------------------------------------------ models and what-if


def _baseline(mart: LiveMart) -> DataFrame:
    row = whatif.baseline(_prepared(mart))
    return row.select(
        *[
            F.round(name, 4).alias(name) if kind == "double" else F.col(name)
            for name, kind in row.dtypes
        ]
    )


def _labelled(mart: Mart) -> DataFrame:
    return whatif.training_rows(_prepared(mart))


def _predictors(mart: LiveMart) -> DataFrame:
    return _prepared(mart).select(
        "order_id", "order_item_id", "review_score", *whatif.FEATURES
    )


def _simulated(mart: LiveMart) -> DataFrame:
    rows = whatif.rule_scores(whatif.simulate(_prepared(mart)))
    changed = [name for name in rows.columns if name.endswith("_sim")]
    return rows.select(
        "order_id",
        "order_item_id",
        "scenario_id",
        *[F.round(name, 6).alias(name) if "_days" in name else F.col(name) for name in changed],
        F.round("predicted", 3).alias("predicted"),
    )


def _rule_summary(mart: LiveMart, bootstrap: bool = False) -> DataFrame:
    summary = whatif.rule_summary(_prepared(mart), bootstrap)
    return summary.drop("description", "solution_recommendation")


def _best(mart: LiveMart) -> DataFrame:
    return whatif.best_scenario(whatif.rule_summary(_prepared(mart))).select(
        "scenario_id", "scenario_name", "projected_avg_review", "review_delta"
    )


def _rule_detail(mart: LiveMart) -> DataFrame:
    detail = whatif.order_detail(_prepared(mart))
    return detail.withColumn("delivery_delay_days", F.round("delivery_delay_days", 6))


def _forest_detail(mart: LiveMart) -> DataFrame:
    return whatif.order_detail(_prepared(mart), models.fit_review_forest(_labelled(mart)))


def _trend_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream; the totals of all micro-batches together."""
    folder = scratch.new_folder(spark, "trend")
    stream = (
        # a stream takes folders; the pattern matches one file as well as a folder of parts
        spark.readStream.schema(testtables.SCHEMAS["events"]).parquet(f"{sf_dir}/events.parque[t]")
    )
    running = trend.start_trend(
        testtables.events_as_items(stream), f"{folder}/trend", f"{folder}/state", once=True
    )
    running.awaitTermination()
    return (
        trend.read_trend(spark, f"{folder}/trend")
        .groupBy(F.col(tables.CATEGORY).alias("category"))
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
        )
    )


OPERATORS: dict[str, RunQuery] = {
    "input_payments_per_order": _on_mart(lambda m: fact.payments_per_order(m.inputs.order_payments)),
    "input_latest_reviews": _on_mart(lambda m: fact.newest_reviews(m.inputs)),
    "input_products_in_english": _on_mart(_products),
    "input_order_measures": _on_mart(_order_measures),
    "fact_before_imputation": _on_mart(_raw_fact),
    "fact_order_grain": _on_mart(_order_grain),
    "fact_latest_snapshot": _snapshot,
    "state_totals": _on_mart(tables.state_totals),
    "loyalty_once_per_order": _on_mart(
        lambda m: timestamps_to_text(tables.loyalty_rfm(m, once_per_order=True))
    ),
    "payments_once_per_order": _on_mart(lambda m: tables.payment_analysis(m, once_per_order=True)),
    "delivery_delivered_only": _on_mart(
        lambda m: tables.delivery_performance(m, delivered_only=True)
    ),
    "text_keyword_tokens": _on_mart(_tokens),
    "text_term_counts": _term_counts,
    "text_corpus_scores": _corpus_scores,
    "text_corpus_keywords": _corpus_keywords,
    "text_complaint_causes": _on_mart(_complaints),
    "text_notebook_words": _on_mart(_notebook_words),
    "text_cleaned_reviews": _on_mart(_cleaned_texts),
    "whatif_baseline": _on_mart(_baseline),
    "whatif_predictors": _on_mart(_predictors),
    "whatif_simulated_rows": _on_mart(_simulated),
    "whatif_rule_summary": _on_mart(_rule_summary),
    "whatif_bootstrap_summary": _on_mart(lambda m: _rule_summary(m, bootstrap=True)),
    "whatif_best_scenario": _on_mart(_best),
    "whatif_rule_detail": _on_mart(_rule_detail),
    "whatif_forest_detail": _on_mart(_forest_detail),
    "ml_customer_clusters": _on_mart(tables.customer_loyalty_rfm),
    "ml_cluster_profile": _on_mart(lambda m: models.cluster_profile(tables.loyalty_rfm(m))),
    "ml_elbow": _on_mart(lambda m: models.elbow(tables.loyalty_rfm(m))),
    "ml_cross_validated_fit": _on_mart(
        lambda m: models.cross_validated_fit(_labelled(m))
    ),
    "ml_holdout_quality": _on_mart(
        lambda m: models.holdout_quality(m.items("order_id", "review_score", *models.DRIVERS))
    ),
    "ml_forest_scenarios": _on_mart(tables.simulation_scenarios),
    "stream_category_trend": _trend_stream,
}


def all_queries() -> dict[str, RunQuery]:
    found = {name: _on_mart(build) for name, build in dashboards.QUERIES.items()}
    for name, build in tables.BUILDERS.items():
        found[f"agg_{name}"] = _on_mart(REPEATABLE.get(name, build))
    # the scenario notes are prose and no result
    found["agg_simulation_scenarios"] = _on_mart(_rule_summary)
    return found | OPERATORS | roundtrips.queries(REPEATABLE)
