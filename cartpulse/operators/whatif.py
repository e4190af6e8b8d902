"""What-if projections: change the delivery facts, score again, compare.

Every scenario is a chain of column changes. For the summary the rows are
repeated once per scenario by an ``explode`` and all scenarios run in the same
pass; each change applies only to the scenarios that contain it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.functions.labels import HEAVY_GRAMS, HIGH_FREIGHT, negative, positive
from cartpulse.operators import forests, models
from cartpulse.operators.forests import FittedForest

SOURCES = (
    "delivery_delay_days",
    "shipping_duration_days",
    "freight_value",
    "price",
    "product_weight_g",
)

# Clipping ranges, assumed effects and floors.
CLIPS = {
    "delivery_delay_days": (-30.0, 60.0),
    "shipping_duration_days": (0.0, 60.0),
    "freight_value": (0.0, 150.0),
    "product_weight_g": (0.0, 20000.0),
    "price": (0.0, 1000.0),
}
SLOW_APPROVAL_DELAY = 14.0
FASTER_APPROVAL_DAYS = 1.5
BAD_SELLER_DAYS = 2.0
FREIGHT_CAP = 30.0
DELAY_FLOOR, CLIPPED_DELAY_FLOOR, DURATION_FLOOR = -146.0, -30.0, 1.0
LATE_UPLIFT, FREIGHT_UPLIFT = 1.708, 0.1
LOWEST_SCORE, HIGHEST_SCORE = 1.0, 5.0
ORDERS_PER_POINT = 0.05
# Of a Poisson number with mean 1, in 65536ths: the chance of at most 0, 1, 2 ...
POISSON_BOUNDS = [
    int(65_536 * sum(math.exp(-1) / math.factorial(i) for i in range(n + 1))) for n in range(8)
]
DRAWS = 8  # 16-bit numbers in an MD5
Z_95 = 1.96

# Predictors of the review forest, with their labels.
FEATURE_LABELS = {
    "is_late": "Late Delivery (binary)",
    "is_high_freight": "High Freight Cost >30 (binary)",
    "is_heavy_product": "Heavy Product >5kg (binary)",
    "is_likely_slow_approval": "Likely Slow Approval (binary)",
    "delivery_delay_days_clipped": "Delivery Delay Days",
    "shipping_duration_days_clipped": "Shipping Duration Days",
    "freight_value_clipped": "Freight Value (BRL)",
    "product_weight_g_clipped": "Product Weight (g)",
    "price_clipped": "Product Price (BRL)",
}
FEATURES = tuple(FEATURE_LABELS)

# Scenario ids and names. The notes are ours.
SCENARIOS = {
    "S1": (
        "Eliminate Late Delivery",
        "Every late delivery arrives on its promised day.",
        "Add carrier capacity where deliveries are late most often.",
    ),
    "S2": (
        "Accelerate Order Approval (<6h)",
        "Orders with an extreme delay gain a day and a half from faster approval.",
        "Approve small orders automatically and set an approval deadline.",
    ),
    "S3": (
        "Cap Freight Cost (≤30 BRL)",
        "No customer pays more than the freight cap.",
        "Negotiate volume rates and subsidise heavy or distant shipments.",
    ),
    "S4": (
        "Remove Underperforming Sellers",
        "Late orders that are also heavy or dear to ship arrive two days earlier.",
        "Coach or suspend sellers with low scores and many late orders.",
    ),
    "S5": (
        "Best Case — All Solutions Combined",
        "All four measures, one after the other.",
        "Start with logistics and sellers, then approval, then freight.",
    ),
}

_CHANGED = (
    "delivery_delay_days",
    "delivery_delay_days_clipped",
    "shipping_duration_days",
    "shipping_duration_days_clipped",
    "freight_value",
    "freight_value_clipped",
    "is_late",
    "is_high_freight",
    "is_likely_slow_approval",
)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value; NULL stays NULL (``greatest``/``least`` would skip it)."""
    limited = value
    if low is not None:
        limited = F.when(value < low, F.lit(low)).otherwise(limited)
    if high is not None:
        limited = F.when(value > high, F.lit(high)).otherwise(limited)
    return limited


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def check_columns(df: DataFrame) -> None:
    absent = sorted({"review_score", *SOURCES} - set(df.columns))
    if absent:
        raise ValueError(f"columns not found: {absent}")


def prepare(rows: DataFrame) -> DataFrame:
    """Reviewed rows with flags and clipped predictors."""
    check_columns(rows)
    clipped = {f"{name}_clipped": clip(F.col(name), *CLIPS[name]) for name in CLIPS}
    return rows.filter(F.col("review_score").isNotNull()).withColumns(
        {
            "is_late": _flag(F.col("delivery_delay_days") > 0),
            "is_high_freight": _flag(F.col("freight_value") > HIGH_FREIGHT),
            "is_heavy_product": _flag(F.col("product_weight_g") > HEAVY_GRAMS),
            "is_likely_slow_approval": _flag(F.col("delivery_delay_days") > SLOW_APPROVAL_DELAY),
            **clipped,
        }
    )


def baseline(prepared: DataFrame) -> DataFrame:
    """Metrics of the rows as they are, in one aggregate."""
    score = F.col("review_score")

    def pct(condition: Column) -> Column:
        return F.try_divide(F.count_if(condition), F.count("*")) * 100.0

    return prepared.agg(
        F.count("*").alias("total_orders"),
        F.avg("review_score").alias("avg_review_score"),
        pct(positive(score)).alias("positive_pct"),
        pct(negative(score)).alias("negative_pct"),
        pct(score == 3).alias("neutral_pct"),
        pct(F.col("is_late") == 1).alias("late_delivery_pct"),
        pct(F.col("is_high_freight") == 1).alias("high_freight_pct"),
        pct(F.col("is_heavy_product") == 1).alias("heavy_product_pct"),
        F.avg("shipping_duration_days").alias("avg_shipping_days"),
        F.avg("freight_value").alias("avg_freight_value"),
    )


# ------------------------------------------------------------------ changes


def average_late_delay(prepared: DataFrame) -> Column:
    """Mean delay of the late rows as a scalar subquery, summed in whole seconds."""
    late = prepared.filter(F.col("delivery_delay_days") > 0)
    seconds = F.sum(F.rint(F.col("delivery_delay_days") * 86400.0).cast("long"))
    return late.agg(F.try_divide(seconds, F.count("*") * 86400).alias("days")).scalar()


class _Changes:
    """The four measures; ``applies`` tells for a scenario id whether a row is meant."""

    def __init__(self, late_delay: Column, applies: Callable[[str], Column], suffix: str) -> None:
        self.late_delay = late_delay
        self.applies = applies
        self.suffix = suffix

    def _col(self, name: str) -> Column:
        return F.col(name + self.suffix)

    def _set(self, df: DataFrame, scenario: str, changes: dict[str, Column]) -> DataFrame:
        meant = self.applies(scenario)
        return df.withColumns(
            {
                name + self.suffix: F.when(meant, new).otherwise(self._col(name))
                for name, new in changes.items()
            }
        )

    def _earlier(self, mask: Column, name: str, days: Column | float, floor: float) -> Column:
        value = self._col(name)
        return F.when(mask, clip(value - days, low=floor)).otherwise(value)

    def _refreshed_flags(self, df: DataFrame, scenario: str) -> DataFrame:
        delay = self._col("delivery_delay_days")
        return self._set(
            df,
            scenario,
            {
                "is_late": _flag(delay > 0),
                "is_likely_slow_approval": _flag(delay > SLOW_APPROVAL_DELAY),
            },
        )

    def no_late_delivery(self, df: DataFrame) -> DataFrame:
        late = self._col("delivery_delay_days") > 0
        changed = self._set(
            df,
            "S1",
            {
                name: F.when(late, F.lit(0.0)).otherwise(self._col(name))
                for name in ("delivery_delay_days", "delivery_delay_days_clipped")
            }
            | {
                name: self._earlier(late, name, self.late_delay, DURATION_FLOOR)
                for name in ("shipping_duration_days", "shipping_duration_days_clipped")
            },
        )
        return self._refreshed_flags(changed, "S1")

    def faster_approval(self, df: DataFrame) -> DataFrame:
        slow = self._col("delivery_delay_days") > SLOW_APPROVAL_DELAY
        floors = {
            "delivery_delay_days": DELAY_FLOOR,
            "delivery_delay_days_clipped": CLIPPED_DELAY_FLOOR,
            "shipping_duration_days": DURATION_FLOOR,
            "shipping_duration_days_clipped": DURATION_FLOOR,
        }
        changed = self._set(
            df,
            "S2",
            {n: self._earlier(slow, n, FASTER_APPROVAL_DAYS, floor) for n, floor in floors.items()},
        )
        return self._refreshed_flags(changed, "S2")

    def capped_freight(self, df: DataFrame) -> DataFrame:
        return self._set(
            df,
            "S3",
            {
                "freight_value": clip(self._col("freight_value"), high=FREIGHT_CAP),
                "freight_value_clipped": clip(self._col("freight_value_clipped"), high=FREIGHT_CAP),
                "is_high_freight": F.lit(0),
            },
        )

    def no_bad_sellers(self, df: DataFrame) -> DataFrame:
        # the clipped duration stays as it is
        bad = (self._col("is_late") == 1) & (
            (self._col("is_high_freight") == 1) | (F.col("is_heavy_product") == 1)
        )
        floors = {
            "delivery_delay_days": DELAY_FLOOR,
            "delivery_delay_days_clipped": CLIPPED_DELAY_FLOOR,
            "shipping_duration_days": DURATION_FLOOR,
        }
        changed = self._set(
            df, "S4", {n: self._earlier(bad, n, BAD_SELLER_DAYS, floor) for n, floor in floors.items()}
        )
        return self._refreshed_flags(changed, "S4")

    def run(self, df: DataFrame) -> DataFrame:
        started = df.withColumns({n + self.suffix: F.col(n) for n in _CHANGED})
        steps = (
            self.no_late_delivery,
            self.faster_approval,
            self.capped_freight,
            self.no_bad_sellers,
        )
        return reduce(DataFrame.transform, steps, started)


_SIM = "_sim"


def simulate(prepared: DataFrame) -> DataFrame:
    """Every row once per scenario; changed columns carry the suffix ``_sim``."""
    scenario = F.col("scenario_id")
    repeated = prepared.withColumn(
        "scenario_id", F.explode(F.array(*[F.lit(name) for name in SCENARIOS]))
    )
    changes = _Changes(
        average_late_delay(prepared), lambda name: scenario.isin(name, "S5"), _SIM
    )
    return changes.run(repeated)


# ------------------------------------------------------------------ scores


def rule_scores(simulated: DataFrame) -> DataFrame:
    """Scores by the fixed uplifts: now on time, and cheaper freight."""
    on_time_now = (F.col("is_late") == 1) & (F.col("is_late" + _SIM) == 0)
    cheaper = F.col("freight_value" + _SIM) < F.col("freight_value")
    score = F.col("review_score").cast("double")
    return simulated.withColumn(
        "predicted", F.when(on_time_now, F.least(score + LATE_UPLIFT, F.lit(5.0))).otherwise(score)
    ).withColumn(
        "predicted",
        F.when(cheaper, F.least(F.col("predicted") + FREIGHT_UPLIFT, F.lit(5.0))).otherwise(
            F.col("predicted")
        ),
    )


def _predictor_names(suffix: str) -> list[str]:
    return [n + suffix if n in _CHANGED and suffix else n for n in FEATURES]


def _values(suffix: str) -> Column:
    """The predictors as an array, NULL as 0, reading changed columns where they exist."""
    return F.array(*[F.coalesce(F.col(n), F.lit(0)).cast("double") for n in _predictor_names(suffix)])


def _features(df: DataFrame, suffix: str, into: str = "features") -> DataFrame:
    """Assemble the predictors, NULL as 0, reading changed columns where they exist."""
    names = _predictor_names(suffix)
    filled = {f"_{into}_{i}": F.coalesce(F.col(n), F.lit(0.0)) for i, n in enumerate(names)}
    return models.assemble(df.withColumns(filled), list(filled), into).drop(*filled)


def training_rows(prepared: DataFrame) -> DataFrame:
    return _features(prepared, "")


def forest_scores(simulated: DataFrame, model: FittedForest) -> DataFrame:
    """Sums of the rows of every scenario and cell of the forest, with the cell's score.

    All rows of a cell have one score, so they are summed before it is worked out.
    """
    values = [F.coalesce(F.col(n), F.lit(0)).cast("double") for n in _predictor_names(_SIM)]
    placed = simulated.withColumn("_cell", forests.cell_key(values, model.thresholds))
    summed = placed.groupBy("scenario_id", "_cell").agg(*_row_sums())
    scored = model.scored(summed, "_cell", "prediction")
    return scored.withColumn(
        "predicted", clip(F.col("prediction"), LOWEST_SCORE, HIGHEST_SCORE)
    ).drop("_cell", "prediction")


def affected() -> Column:
    pairs = [(n, n + _SIM) for n in ("is_late", "freight_value", "delivery_delay_days")]
    return reduce(lambda a, b: a | b, [~F.col(old).eqNullSafe(F.col(new)) for old, new in pairs])


def _row_sums() -> list[Column]:
    """What the summary counts and sums of rows, whatever is predicted for them."""
    score = F.col("review_score")
    return [
        F.count("*").alias("total_orders"),
        F.count_if(affected()).alias("affected_orders"),
        F.sum(score.cast("long")).alias("score_sum"),
        F.count_if(positive(score)).alias("was_positive"),
        F.count_if(negative(score)).alias("was_negative"),
        F.count_if(score == 3).alias("was_neutral"),
        F.sum(F.rint(F.col("price") * 10000.0).cast("long")).alias("price_sum"),
    ]


SUMMED = (
    "total_orders", "affected_orders", "score_sum", "was_positive", "was_negative", "was_neutral",
    "price_sum",
)


def summarise(scored: DataFrame, model_type: str) -> DataFrame:
    """One row per scenario: baseline, projection, deltas, interval, revenue.

    ``scored`` has rows, or sums of rows with one prediction. The baseline comes from the
    same grouped pass. The interval is the normal 95 % interval of the mean.
    """
    predicted = F.col("predicted")
    n = F.col("total_orders")
    micro = 1_000_000.0
    if n_given := "total_orders" in scored.columns:
        sums, rows = [F.sum(name).alias(name) for name in SUMMED], n
    else:
        sums, rows = _row_sums(), F.lit(1).cast("long")

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)).cast("long")

    mean = F.sum(rows * predicted) / F.sum(rows)
    spread = F.sum(rows * predicted * predicted) / F.sum(rows) - mean * mean
    grouped = scored.groupBy("scenario_id").agg(
        *sums,
        F.sum(rows * F.rint(predicted * micro).cast("long")).alias("predicted_sum"),
        counted(predicted >= 4).alias("is_positive"),
        counted(predicted <= 2).alias("is_negative"),
        counted((predicted > 2) & (predicted < 4)).alias("is_neutral"),
        (F.greatest(spread, F.lit(0.0)) if n_given else F.var_pop(predicted)).alias("variance"),
    )
    rates = grouped.withColumns(
        {
            "base": F.col("score_sum") / n,
            "projected": F.col("predicted_sum") / (n * micro),
            "price": F.col("price_sum") / (n * 10000.0),
            "margin": F.lit(Z_95) * F.sqrt("variance") / F.sqrt(n),
            **{
                f"{name}_pct": F.col(name) / n * 100.0
                for name in (
                    "was_positive", "was_negative", "was_neutral",
                    "is_positive", "is_negative", "is_neutral",
                )
            },
        }
    ).withColumn("delta", F.col("projected") - F.col("base"))
    more_orders = F.floor(n * F.greatest("delta", F.lit(0.0)) * ORDERS_PER_POINT)

    def told(position: int) -> Column:
        pairs = [x for key, notes in SCENARIOS.items() for x in (F.lit(key), F.lit(notes[position]))]
        return F.element_at(F.create_map(*pairs), F.col("scenario_id"))

    return rates.select(
        "scenario_id",
        told(0).alias("scenario_name"),
        told(1).alias("description"),
        told(2).alias("solution_recommendation"),
        "total_orders",
        "affected_orders",
        F.round(F.col("affected_orders") / n * 100.0, 2).alias("affected_pct"),
        F.round("base", 4).alias("baseline_avg_review"),
        F.round("was_positive_pct", 2).alias("baseline_positive_pct"),
        F.round("was_negative_pct", 2).alias("baseline_negative_pct"),
        F.round("was_neutral_pct", 2).alias("baseline_neutral_pct"),
        F.round("projected", 4).alias("projected_avg_review"),
        F.round("is_positive_pct", 2).alias("projected_positive_pct"),
        F.round("is_negative_pct", 2).alias("projected_negative_pct"),
        F.round("is_neutral_pct", 2).alias("projected_neutral_pct"),
        F.round("delta", 4).alias("review_delta"),
        F.round(F.col("is_positive_pct") - F.col("was_positive_pct"), 2).alias("positive_delta"),
        F.round(F.col("is_negative_pct") - F.col("was_negative_pct"), 2).alias("negative_delta"),
        F.round(F.col("delta") / F.col("base") * 100.0, 2).alias("review_improvement_pct"),
        F.round(F.col("projected") - F.col("margin"), 4).alias("ci_lower_95"),
        F.round(F.col("projected") + F.col("margin"), 4).alias("ci_upper_95"),
        more_orders.alias("additional_orders_est"),
        F.round(more_orders * F.col("price"), 2).alias("revenue_impact_est_brl"),
        F.lit(model_type).alias("model_type"),
    )


def _drawn(rows: Column, drawn: list[Column]) -> Column:
    """How often a bin of so many rows is drawn: a whole number, Poisson with that mean.

    Up to ``len(drawn)`` rows are drawn one by one, each from a 16-bit number; the number
    of more rows is taken as normal, from the sum of all of them.
    """
    each = [
        sum((F.when(u >= bound, 1).otherwise(0) for bound in POISSON_BOUNDS), F.lit(0))
        for u in drawn
    ]
    one_by_one = sum(
        (F.when(rows > i, times).otherwise(0) for i, times in enumerate(each)), F.lit(0)
    )
    spread = sum(drawn[1:], drawn[0]) - len(drawn) * 65_535 / 2
    deviation = 65_536 * math.sqrt(len(drawn) / 12)
    normal = F.floor(rows + F.sqrt(rows.cast("double")) * (spread / deviation) + 0.5)
    return F.when(rows <= len(drawn), one_by_one).otherwise(F.greatest(normal, F.lit(0)))


def bootstrap_interval(
    scored: DataFrame, replicates: int = 500, seed: int = models.SEED
) -> DataFrame:
    """95 % percentile interval of the mean score by a seeded Poisson bootstrap.

    Works on the histogram of the scores in thousandths, as they are reported, not on the
    rows, which may be given as sums of rows with one score. Draws come from the MD5 of seed, scenario, score and replicate, so any
    engine draws the same ones.
    """
    histogram = scored.groupBy(
        "scenario_id", F.rint(F.col("predicted") * 1000.0).cast("long").alias("score")
    ).agg((F.sum("total_orders") if "total_orders" in scored.columns else F.count("*")).alias("rows"))
    name = F.concat_ws("-", F.lit(str(seed)), "scenario_id", "score", "replicate")
    digits = [
        F.conv(F.substring("digest", 4 * i + 1, 4), 16, 10).cast("long") for i in range(DRAWS)
    ]
    drawn = (
        histogram.select(
            "*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")
        )
        .withColumn("digest", F.md5(name.cast("binary")))
        .withColumns({f"u{i}": digit for i, digit in enumerate(digits)})
        .withColumn("times", _drawn(F.col("rows"), [F.col(f"u{i}") for i in range(DRAWS)]))
    )
    # whole numbers, so the order of the sums does not matter
    means = drawn.groupBy("scenario_id", "replicate").agg(
        F.try_divide(
            F.sum(F.col("times") * F.col("score")).cast("double"), F.sum("times") * 1000.0
        ).alias("mean")
    )
    return means.groupBy("scenario_id").agg(
        F.round(F.percentile("mean", F.lit(0.025)), 4).alias("ci_lower_95"),
        F.round(F.percentile("mean", F.lit(0.975)), 4).alias("ci_upper_95"),
    )


def with_bootstrap(summary: DataFrame, scored: DataFrame, replicates: int = 500) -> DataFrame:
    """The summary with bootstrap intervals in place of the normal ones."""
    columns = summary.columns
    drawn = bootstrap_interval(scored, replicates)
    return (
        summary.drop("ci_lower_95", "ci_upper_95").join(drawn, "scenario_id").select(*columns)
    )


def rule_summary(prepared: DataFrame, bootstrap: bool = False) -> DataFrame:
    scored = rule_scores(simulate(prepared))
    summary = summarise(scored, "RuleBased")
    return with_bootstrap(summary, scored) if bootstrap else summary


def forest_summary(
    prepared: DataFrame,
    model: FittedForest | None = None,
    bootstrap: bool = False,
) -> DataFrame:
    """Scenario summary by the forest, fitted here unless one is given.

    Fit and scoring read the same kept rows. What leaves is one row per
    scenario, so it is taken out before the rows are let go.
    """
    spark = prepared.sparkSession
    read = dict.fromkeys(("review_score", "price", *FEATURES, *_CHANGED))
    with models.kept(prepared.select(*read)) as rows:
        fitted = model or models.review_forest().fit(training_rows(rows))
        scored = forest_scores(simulate(rows), fitted)
        summary = summarise(scored, "RandomForest")
        if bootstrap:
            summary = with_bootstrap(summary, scored)
        return spark.createDataFrame(summary.collect(), summary.schema)


def best_scenario(summary: DataFrame) -> DataFrame:
    """The scenario that lifts the average score most."""
    return summary.orderBy(F.desc("review_delta"), "scenario_id").limit(1)


def feature_impact(prepared: DataFrame) -> DataFrame:
    """Normalised importances of the review forest with its cross-validated fit."""
    fitted = models.cross_validate(training_rows(prepared))
    weights = fitted.model.featureImportances.toArray()
    whole = float(weights.sum()) or 1.0
    fit = round(fitted.mean(), 4)
    rows = [
        (name, label, round(float(weight) / whole * 100, 2), fit)
        for (name, label), weight in zip(FEATURE_LABELS.items(), weights, strict=True)
    ]
    schema = "feature_name string, feature_label string, importance_pct double, model_r2 double"
    return prepared.sparkSession.createDataFrame(rows, schema).orderBy(
        F.desc("importance_pct"), "feature_name"
    )


def order_detail(
    prepared: DataFrame, model: FittedForest | None = None
) -> DataFrame:
    """Actual and predicted score per row for every scenario, side by side.

    Each scenario has its own set of changed columns, so the rows are not repeated.
    Without a model the predictions are the actual scores.
    """
    late_delay = average_late_delay(prepared)
    df = prepared
    predicted = dict.fromkeys(SCENARIOS, F.col("review_score").cast("double"))
    if model is not None:
        for name in SCENARIOS:
            suffix = f"_{name}"
            changes = _Changes(
                late_delay, lambda step, name=name: F.lit(name in (step, "S5")), suffix
            )
            df = changes.run(df).withColumn(f"_values{suffix}", _values(suffix))
        scores = {f"_values_{name}": f"prediction_{name}" for name in SCENARIOS}
        df = models.cell_scores(df, model, scores)
        predicted = {
            name: clip(F.col(f"prediction_{name}"), LOWEST_SCORE, HIGHEST_SCORE)
            for name in SCENARIOS
        }
    df = df.withColumns({f"predicted_review_{n}": F.round(p, 3) for n, p in predicted.items()})
    keys = [name for name in ("order_id", "order_item_id") if name in prepared.columns]
    return df.select(
        *keys,
        F.col("review_score").alias("actual_review"),
        "delivery_delay_days",
        "freight_value",
        "is_late",
        "is_high_freight",
        "is_heavy_product",
        *[f"predicted_review_{name}" for name in SCENARIOS],
        F.round(F.col("predicted_review_S5") - F.col("review_score"), 3).alias("max_uplift_S5"),
    )
