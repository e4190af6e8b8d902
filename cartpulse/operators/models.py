"""Customer clusters, and review-score forests."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from cartpulse.operators import clusters, forests
from cartpulse.operators.forests import FittedForest, Forest
from cartpulse.sources import scratch

SEED = 42
CLUSTERS = 4
# Scores of up to so many cells are sent to all tasks, more meet their rows in a shuffle.
CELLS_TO_SEND = 1 << 20
# Rows that a task of a fit passes over, once all cores have some.
ROWS_PER_TASK = 1_000_000
RFM = ("recency_days", "frequency", "monetary")
# Predictors of the driver forest.
DRIVERS = (
    "delivery_delay_days",
    "shipping_duration_days",
    "freight_value",
    "price",
    "product_weight_g",
)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep rows for an iterative fit; recomputed from lineage if a node is lost.

    The rows are rebalanced by size first. A fit passes over them many times, and
    every pass takes as long as the largest partition. A forest's pass also sends the
    statistics of all its nodes from every task, so there are no more tasks than cores
    until they have ``ROWS_PER_TASK`` rows each.
    """
    even = df.hint("rebalance").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        yield even.coalesce(cores * max(1, math.ceil(even.count() / (cores * ROWS_PER_TASK))))
    finally:
        even.unpersist()


# ------------------------------------------------------------------ clusters


def with_clusters(customers: DataFrame, k: int = CLUSTERS) -> DataFrame:
    """Customers with a ``kmeans_cluster`` label; equal customers get equal ones in any run."""
    found = clusters.fit(customers, RFM, [k], kept)[k]
    label = F.concat(F.lit("Cluster "), found.label().cast("string"))
    return customers.na.fill(dict.fromkeys(RFM, 0)).withColumn("kmeans_cluster", label)


def cluster_profile(customers: DataFrame, k: int = CLUSTERS) -> DataFrame:
    return (
        with_clusters(customers, k)
        .groupBy("kmeans_cluster")
        .agg(
            F.avg("recency_days").alias("avg_recency"),
            F.avg("frequency").alias("avg_frequency"),
            F.avg("monetary").alias("avg_monetary"),
            F.count("*").alias("customers"),
        )
    )


def elbow(customers: DataFrame, largest_k: int = 8) -> DataFrame:
    """Within-cluster sum of squares for k = 1 .. ``largest_k``, all from the same passes."""
    found = clusters.fit(customers, RFM, range(1, largest_k + 1), kept)
    costs = [(k, one.cost) for k, one in sorted(found.items())]
    return customers.sparkSession.createDataFrame(costs, "k int, sse double")


# ------------------------------------------------------------------ forests


def assemble(df: DataFrame, predictors: Sequence[str], into: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(predictors), outputCol=into).transform(df)


def driver_importances(items: DataFrame) -> DataFrame:
    """Importance (in percent) of the drivers of a review score; empty without data."""
    spark = items.sparkSession
    rows = assemble(items.select("review_score", *DRIVERS).na.drop(), DRIVERS)
    schema = "feature_name string, importance_pct double"
    forest = RandomForestRegressor(labelCol="review_score", numTrees=10, maxDepth=5, seed=SEED)
    with kept(rows.select("features", "review_score")) as training:
        if training.isEmpty():
            return spark.createDataFrame([], schema)
        weights = forest.fit(training).featureImportances.toArray()
    return spark.createDataFrame(
        [(name, float(w) * 100) for name, w in zip(DRIVERS, weights, strict=True)], schema
    )


def forest_thresholds(model: FittedForest) -> list[list[float]]:
    """The values at which the forest tells each feature apart, ascending."""
    return model.thresholds


def cell_scores(rows: DataFrame, model: FittedForest, inputs: Mapping[str, str]) -> DataFrame:
    """Rows with scores of the forest; ``inputs`` maps columns of feature arrays to scores.

    A forest can't tell values between two thresholds apart. Every different cell that the
    thresholds make is scored once and the rows get its score. Scores of up to
    ``CELLS_TO_SEND`` cells are sent to all tasks, more meet their rows in a shuffle.
    """
    features = range(len(model.thresholds))
    keys = {
        f"_cell_{name}": forests.cell_key([F.get(name, F.lit(i)) for i in features], model.thresholds)
        for name in inputs
    }
    placed = rows.withColumns(keys)
    cells = placed.select(F.explode(F.array(*keys)).alias("_cell")).distinct()
    folder = scratch.new_folder(rows.sparkSession, "forest-cells")
    model.scored(cells, "_cell", "_score").write.parquet(folder)
    scored = rows.sparkSession.read.schema("_cell bigint, _score double").parquet(folder)
    sent = scored.count() <= CELLS_TO_SEND
    for name, into in inputs.items():
        one = scored.select(F.col("_cell").alias(f"_cell_{name}"), F.col("_score").alias(into))
        placed = placed.join(F.broadcast(one) if sent else one, f"_cell_{name}").drop(f"_cell_{name}")
    return placed


def review_forest() -> Forest:
    return Forest(trees=200, depth=8, min_rows=10, seed=SEED)


def sample_place(columns: Sequence[str]) -> Column | None:
    """Where a row comes in the order of the labelled sample, by its key; None without one."""
    keys = [name for name in ("order_id", "order_item_id") if name in columns]
    return F.xxhash64(*keys) if keys else None


def labelled_sample(training: DataFrame, max_labelled: int | None = None) -> DataFrame:
    """All rows, or the ``max_labelled`` first by a hash of their key where that is asked for."""
    if max_labelled is None:
        return training
    place = sample_place(training.columns)
    if place is None:
        place = F.xxhash64(F.col("features").cast("string"))
    return training.orderBy(place).limit(max_labelled)


def fit_review_forest(training: DataFrame, max_labelled: int | None = None) -> FittedForest:
    with kept(labelled_sample(training, max_labelled).select("features", "review_score")) as rows:
        return review_forest().fit(rows)


@dataclass(frozen=True)
class CrossValidated:
    """A forest fitted on all rows, and R squared on each fold of one that has not seen it."""

    model: FittedForest
    r2: list[float]

    def mean(self) -> float:
        return float(np.mean(self.r2))

    def deviation(self) -> float:
        return float(np.std(self.r2))


def cross_validate(
    training: DataFrame, folds: int = 5, max_labelled: int | None = None
) -> CrossValidated:
    """k-fold R squared of the review forest, and the forest of all rows.

    The fold of a row follows from its values and so survives recomputation. All fits run
    at a time over one set of kept rows, so that the tasks of one fill the gaps between
    the jobs of another.
    """
    # items of an order share its score and so its fold
    key = F.col("order_id") if "order_id" in training.columns else F.col("features").cast("string")
    fold = F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")
    bounded = labelled_sample(training, max_labelled)
    with kept(bounded.select("features", "review_score", fold.alias("fold"))) as rows:
        rows.count()

        def fitted(held_out: int | None) -> FittedForest | float:
            if held_out is None:
                return review_forest().fit(rows)
            model = review_forest().fit(rows.filter(F.col("fold") != held_out))
            return _r2(*model.errors(rows.filter(F.col("fold") == held_out)))

        with ThreadPoolExecutor(folds + 1) as pool:
            tasks = [
                pool.submit(inheritable_thread_target(training.sparkSession)(fitted), one)
                for one in (None, *range(folds))
            ]
            model, *r2 = [task.result() for task in tasks]
    return CrossValidated(model, [float(one) for one in r2])


def cross_validated_fit(training: DataFrame, folds: int = 5) -> DataFrame:
    """Mean and standard deviation of R squared over the folds."""
    found = cross_validate(training, folds)
    row = (folds, found.mean(), found.deviation())
    return training.sparkSession.createDataFrame([row], "folds int, r2_mean double, r2_std double")


def _r2(mse: float, spread: float) -> float:
    return 1 - mse / spread if spread else math.nan


def holdout_quality(items: DataFrame, predictors: Sequence[str] = DRIVERS) -> DataFrame:
    """MSE and R squared of a forest on a held-out fifth of the complete rows."""
    spark = items.sparkSession
    keyed = "order_id" in items.columns
    # by order, so that a recomputed row falls in the same part; items of an order too
    fifth = F.pmod(F.xxhash64("order_id"), F.lit(5)) if keyed else F.lit(None).cast("long")
    columns = items.select("review_score", *predictors, fifth.alias("fifth"))
    rows = assemble(columns.na.drop(subset=["review_score", *predictors]), predictors)
    forest = Forest(trees=100, depth=10, seed=SEED)
    with kept(rows.select("features", "review_score", "fifth")) as complete:
        if keyed:
            training, held_out = complete.filter("fifth <> 0"), complete.filter("fifth = 0")
        else:
            training, held_out = complete.randomSplit([0.8, 0.2], seed=SEED)
        mse, spread = forest.fit(training).errors(held_out)
    measured = [("mse", mse), ("r2", _r2(mse, spread))]
    return spark.createDataFrame(measured, "metric string, value double")
