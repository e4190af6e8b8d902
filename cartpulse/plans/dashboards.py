"""The fifty dashboard queries, in eight tabs, as DataFrames over a ``Mart``.

Every limited query has a unique tie-breaker, so its rows are well defined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.functions import labels as L
from cartpulse.functions import measures as M
from cartpulse.functions.times import year_month
from cartpulse.plans.mart import Mart

Query = Callable[[Mart], DataFrame]
QUERIES: dict[str, Query] = {}

CATEGORY = "product_category_name_english"
# Fixed value: months, states and routes with fewer orders are noise.
ENOUGH_ORDERS = 50


def _query(build: Query) -> Query:
    # q1_1_kpis is registered as q1_1
    QUERIES["_".join(build.__name__.split("_")[:2])] = build
    return build


def _r(name: str, digits: int, alias: str | None = None) -> Column:
    return F.round(F.col(name), digits).alias(alias or name)


def _category() -> Column:
    return F.col(CATEGORY).alias("category")


def _known(df: DataFrame, column: str = CATEGORY) -> DataFrame:
    return df.filter(F.col(column) != L.MISSING)


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


def _score() -> Column:
    return F.col("review_score")


def _reviewed(mart: Mart, *columns: str) -> DataFrame:
    return mart.orders("review_score", *columns).filter(_score().isNotNull())


# ------------------------------------------------------------------ tab 1: overview


@_query
def q1_1_kpis(mart: Mart) -> DataFrame:
    n_products = mart.items("product_id").select("product_id").distinct()
    row = M.roll_up(
        mart.orders("customer_unique_id", "review_score", "is_late_delivery"),
        [],
        {
            "total_orders": M.rows(),
            "total_customers": M.distinct("customer_unique_id"),
            "total_revenue": M.total("price"),
            "avg_basket_size": M.basket(M.rows()),
            "avg_review_score": M.mean("review_score"),
            "on_time_delivery_pct": M.percent_of(
                F.col("is_late_delivery") == 0,
                "on_time",
                F.col("is_late_delivery").isNotNull(),
                "flagged",
                1,
            ),
        },
        through=("customer_unique_id",),
    )
    rounded = _rounded(row, total_revenue=2, avg_basket_size=1, avg_review_score=2)
    return rounded.withColumn("total_products", n_products.agg(F.count("*").alias("n")).scalar())


@_query
def q1_2_best_categories(mart: Mart) -> DataFrame:
    return (
        _known(mart.table("top_products"))
        .orderBy(F.desc("total_revenue"), CATEGORY)
        .limit(10)
        .select(
            _category(),
            "total_orders",
            _r("total_revenue", 2, "revenue"),
            _r("avg_review_score", 2, "avg_review"),
        )
    )


@_query
def q1_3_revenue_split(mart: Mart) -> DataFrame:
    return (
        _known(mart.table("category_summary"))
        .select(_category(), _r("total_revenue", 2, "revenue"))
        .orderBy(F.desc("revenue"), "category")
        .limit(15)
    )


@_query
def q1_4_score_histogram(mart: Mart) -> DataFrame:
    counts = M.roll_up(_reviewed(mart), ["review_score"], {"total": M.items()})
    return counts.orderBy("review_score")


@_query
def q1_5_order_status(mart: Mart) -> DataFrame:
    counts = M.roll_up(mart.orders("order_status"), ["order_status"], {"total_orders": M.rows()})
    return counts.orderBy(F.desc("total_orders"), "order_status")


def _by_month(mart: Mart, *columns: str) -> DataFrame:
    return (
        mart.orders("order_purchase_timestamp", "review_score", *columns)
        .filter(F.col("order_purchase_timestamp").isNotNull())
        .withColumn("month", year_month(F.col("order_purchase_timestamp")))
    )


@_query
def q1_6_monthly_revenue(mart: Mart) -> DataFrame:
    months = M.roll_up(
        _by_month(mart),
        ["month"],
        {
            "total_orders": M.rows(),
            "revenue": M.total("price"),
            "avg_review": M.mean("review_score"),
        },
    )
    return _rounded(months, revenue=2, avg_review=2).orderBy("month")


@_query
def q1_7_top_and_bottom(mart: Mart) -> DataFrame:
    categories = _known(mart.table("category_summary"))

    def ends(df: DataFrame, order: Column, label: str) -> DataFrame:
        return (
            df.orderBy(order, CATEGORY)
            .limit(3)
            .select(
                _category(),
                "total_orders",
                _r("total_revenue", 2, "revenue"),
                _r("avg_review_score", 2, "avg_review"),
                F.lit(label).alias("label"),
            )
        )

    best = ends(categories, F.desc("total_revenue"), L.TOP)
    worst = ends(categories.filter(F.col("total_orders") >= 10), F.asc("total_revenue"), L.BOTTOM)
    return best.unionByName(worst)


# ------------------------------------------------------------------ tab 2: detail


@_query
def q2_1_weekdays(mart: Mart) -> DataFrame:
    days = M.roll_up(
        mart.orders("order_day_of_week"), ["order_day_of_week"], {"total_orders": M.rows()}
    )
    names = F.array(*[F.lit(name) for name in L.WEEKDAYS])
    return days.withColumn("hari", F.get(names, F.col("order_day_of_week"))).orderBy(
        "order_day_of_week"
    )


@_query
def q2_2_hours(mart: Mart) -> DataFrame:
    return (
        mart.table("hourly_activity")
        .select(
            F.col("order_hour").alias("jam"),
            "total_orders",
            "total_items",
            _r("total_revenue", 2, "revenue"),
        )
        .orderBy("jam")
    )


@_query
def q2_3_heat_map(mart: Mart) -> DataFrame:
    grid = (
        mart.orders("order_hour_of_day", "order_day_of_week")
        .groupBy(F.col("order_hour_of_day").alias("jam"))
        .pivot("order_day_of_week", list(range(7)))
        .agg(F.sum("n_items"))
        .na.fill(0)
    )
    return grid.toDF("jam", *L.WEEKDAYS).orderBy("jam")


@_query
def q2_4_category_detail(mart: Mart) -> DataFrame:
    return (
        _known(mart.table("category_summary"))
        .orderBy(F.desc("total_revenue"), CATEGORY)
        .select(
            _category(),
            "total_items",
            _r("total_revenue", 2, "revenue"),
            _r("avg_review_score", 2, "avg_review"),
            _r("avg_price", 2),
            _r("avg_freight", 2),
        )
    )


@_query
def q2_5_payment_types(mart: Mart) -> DataFrame:
    return (
        _known(mart.table("payment_analysis"), "payment_type")
        .select(
            "payment_type",
            "total_orders",
            _r("total_revenue", 2, "revenue"),
            _r("avg_review_score", 2, "avg_review"),
        )
        .orderBy(F.desc("total_orders"), "payment_type")
    )


def _bucketed(df: DataFrame, name: str, bucket: Column, **measures: M.Measure) -> DataFrame:
    return M.roll_up(
        df.withColumn(name, bucket),
        [name],
        {"total_orders": M.rows(), **measures},
    )


@_query
def q2_6_shipping_buckets(mart: Mart) -> DataFrame:
    buckets = _bucketed(
        mart.orders("shipping_duration_days", "review_score"),
        "delivery_bucket",
        L.at_most(F.col("shipping_duration_days"), L.SHIPPING_LADDER, L.SHIPPING_UNKNOWN),
        avg_review=M.mean("review_score"),
    )
    return _rounded(buckets, avg_review=2).orderBy(F.desc("total_orders"), "delivery_bucket")


@_query
def q2_7_states(mart: Mart) -> DataFrame:
    """One row per state and city under the state's name; equal rows appear once."""
    measures = ["total_orders", "total_revenue", "avg_review_score", "total_customers"]
    return (
        _known(mart.table("geographic_analysis"), "customer_state")
        .select("customer_state", *measures)
        .distinct()
        .orderBy(F.desc("total_orders"), "customer_state", "total_revenue")
        .limit(15)
        .select(
            "customer_state",
            "total_orders",
            _r("total_revenue", 2, "revenue"),
            _r("avg_review_score", 2, "avg_review"),
            "total_customers",
        )
    )


# ------------------------------------------------------------------ tab 3: why scores stagnate


@_query
def q3_1_delay_buckets(mart: Mart) -> DataFrame:
    buckets = _bucketed(
        _reviewed(mart, "delivery_delay_days"),
        "delivery_category",
        L.at_most(F.col("delivery_delay_days"), L.DELAY_LADDER, L.DELAY_UNKNOWN),
        avg_review_score=M.mean("review_score"),
        avg_delay=M.mean_days("delivery_delay_days"),
    )
    return _rounded(buckets, avg_review_score=2, avg_delay=1).orderBy("avg_delay")


def _score_percents() -> dict[str, M.Measure]:
    known = _score().isNotNull()
    return {
        "negative_pct": M.percent_of(L.negative(_score()), "negative", known, "known", 1),
        "positive_pct": M.percent_of(L.positive(_score()), "positive", known, "known", 1),
    }


@_query
def q3_2_late_or_not(mart: Mart) -> DataFrame:
    status = F.when(F.col("is_late_delivery") == 1, L.LATE).otherwise(L.ON_TIME)
    rows = _bucketed(
        _reviewed(mart, "is_late_delivery").filter(F.col("is_late_delivery").isNotNull()),
        "status",
        status,
        avg_review_score=M.mean("review_score"),
        **_score_percents(),
    )
    return _rounded(rows, avg_review_score=2)


@_query
def q3_3_worst_categories(mart: Mart) -> DataFrame:
    return (
        _known(mart.table("review_analysis"))
        .orderBy("avg_review_score", CATEGORY)
        .limit(15)
        .select(
            _category(),
            "total_reviews",
            _r("avg_review_score", 2, "avg_review"),
            _r("negative_review_pct", 1, "negative_pct"),
            _r("positive_review_pct", 1, "positive_pct"),
            _r("late_delivery_pct", 1),
        )
    )


@_query
def q3_4_churn_matrix(mart: Mart) -> DataFrame:
    cells = (
        mart.table("customer_loyalty_rfm")
        .groupBy("loyalty_tier", "churn_risk")
        .agg(
            F.count("*").alias("total_customers"),
            _average_money("total_spend", 2).alias("avg_spend"),
            F.round(F.avg("avg_review_score"), 2).alias("avg_review"),
            F.round(F.avg("recency_days"), 0).alias("avg_recency_days"),
        )
    )
    return cells.orderBy(
        L.rank_of(F.col("loyalty_tier"), L.LOYALTY_TIERS),
        L.rank_of(F.col("churn_risk"), L.CHURN_RISKS),
    )


def _average_money(name: str, digits: int) -> Column:
    units = F.sum(M.money_units(F.col(name)))
    return F.round(units / (F.count(name) * F.lit(float(M.MONEY_UNITS))), digits)


@_query
def q3_5_states(mart: Mart) -> DataFrame:
    gap = F.col("avg_review_when_ontime") - F.col("avg_review_when_late")
    return (
        mart.table("delivery_performance")
        .orderBy(F.desc("late_delivery_pct"), "customer_state")
        .select(
            F.col("customer_state").alias("state"),
            "total_orders",
            _r("avg_delivery_days", 1, "avg_delivery"),
            _r("late_delivery_pct", 1, "late_pct"),
            _r("avg_review_when_late", 2, "review_when_late"),
            _r("avg_review_when_ontime", 2, "review_when_ontime"),
            F.round(gap, 2).alias("review_gap"),
        )
    )


@_query
def q3_6_forecast(mart: Mart) -> DataFrame:
    return (
        _known(mart.table("sales_forecasting"))
        .orderBy(F.desc("current_total_revenue"), CATEGORY)
        .limit(20)
        .select(
            _category(),
            "current_total_orders",
            _r("current_total_revenue", 2, "current_revenue"),
            _r("forecasted_orders", 0, "forecast_orders"),
            _r("forecasted_revenue", 2, "forecast_revenue"),
            F.round(F.col("growth_rate") * 100.0, 1).alias("growth_pct"),
            "risk_level",
        )
    )


@_query
def q3_7_approval_buckets(mart: Mart) -> DataFrame:
    buckets = _bucketed(
        _reviewed(mart, "approval_delay_hours").filter(F.col("approval_delay_hours").isNotNull()),
        "approval_bucket",
        L.at_most(F.col("approval_delay_hours"), L.APPROVAL_LADDER),
        avg_review=M.mean("review_score"),
    )
    order = [label for _, label in L.APPROVAL_LADDER]
    return _rounded(buckets, avg_review=2).orderBy(L.rank_of(F.col("approval_bucket"), order))


# ------------------------------------------------------------------ tab 4: improvements


def _rated_sellers(mart: Mart, order: Column) -> DataFrame:
    return (
        mart.table("seller_performance")
        .filter(F.col("total_orders") >= 10)
        .orderBy(order, "seller_id")
        .limit(20)
        .select(
            "seller_id",
            "seller_city",
            "seller_state",
            "total_orders",
            _r("total_revenue", 2, "revenue"),
            _r("avg_review_score", 2, "avg_review"),
            _r("late_delivery_pct", 1, "late_pct"),
            _r("avg_delivery_days", 1),
        )
    )


@_query
def q4_1_worst_sellers(mart: Mart) -> DataFrame:
    return _rated_sellers(mart, F.asc_nulls_last("avg_review_score"))


@_query
def q4_2_best_sellers(mart: Mart) -> DataFrame:
    return _rated_sellers(mart, F.desc_nulls_last("avg_review_score")).drop("avg_delivery_days")


@_query
def q4_3_categories_to_improve(mart: Mart) -> DataFrame:
    return (
        _known(mart.table("review_analysis"))
        .filter(F.col("total_reviews") >= 20)
        .orderBy(F.desc("negative_review_pct"), CATEGORY)
        .limit(15)
        .select(
            _category(),
            "total_reviews",
            _r("avg_review_score", 2, "avg_review"),
            _r("negative_review_pct", 1, "negative_pct"),
            _r("late_delivery_pct", 1),
            _r("avg_freight_value", 2, "avg_freight"),
        )
    )


@_query
def q4_4_problem_states(mart: Mart) -> DataFrame:
    blended = (
        F.col("avg_review_when_late") * F.col("late_delivery_pct") / 100.0
        + F.col("avg_review_when_ontime") * F.col("on_time_pct") / 100.0
    )
    return (
        mart.table("delivery_performance")
        .filter(F.col("total_orders") >= ENOUGH_ORDERS)
        .select(
            F.col("customer_state").alias("state"),
            "total_orders",
            F.round(blended, 2).alias("avg_review"),
            _r("late_delivery_pct", 1, "late_pct"),
            _r("avg_freight_value", 2, "avg_freight"),
            _r("avg_delivery_days", 1, "avg_delivery"),
        )
        .orderBy("avg_review", "state")
    )


@_query
def q4_5_payment_friction(mart: Mart) -> DataFrame:
    return (
        _known(mart.table("payment_analysis"), "payment_type")
        .orderBy("avg_review_score", "payment_type")
        .select(
            "payment_type",
            "total_orders",
            _r("avg_review_score", 2, "avg_review"),
            _r("avg_installments", 1),
            _r("avg_payment_value", 2, "avg_value"),
        )
    )


@_query
def q4_6_dear_but_disliked(mart: Mart) -> DataFrame:
    return (
        _known(mart.table("products_performance"))
        .filter((F.col("total_orders") >= 5) & (F.col("avg_review_score") < 3.5))
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(20)
        .select(
            "product_id",
            _category(),
            "total_orders",
            _r("total_revenue", 2, "revenue"),
            _r("avg_review_score", 2, "avg_review"),
            "total_unique_buyers",
        )
    )


@_query
def q4_7_capacity(mart: Mart) -> DataFrame:
    return (
        mart.table("hourly_capacity")
        .select(
            "order_hour",
            "total_orders",
            _r("total_revenue", 2, "revenue"),
            _r("avg_items_per_order", 1, "avg_items"),
            _r("capacity_utilization_pct", 1, "utilization_pct"),
            "peak_label",
        )
        .orderBy("order_hour")
    )


# ------------------------------------------------------------------ tab 5: governance


@_query
def q5_1_quality(mart: Mart) -> DataFrame:
    return (
        mart.table("data_quality_report")
        .select(
            "column_name", "total_rows", "missing_count", _r("missing_pct", 2), "ingested_date"
        )
        .orderBy(F.desc("ingested_date"), F.desc("missing_pct"), "column_name")
    )


@_query
def q5_2_freshness(mart: Mart) -> DataFrame:
    trend = mart.table("history_category_trend").agg(
        F.max("batch_time").alias("latest_batch"),
        F.count_distinct(F.when(F.col(CATEGORY) != L.MISSING, F.col(CATEGORY))).alias(
            "categories_tracked"
        ),
        F.count_distinct("ingested_date").alias("total_batch_days"),
    )
    volume = M.roll_up(
        mart.orders("customer_unique_id"),
        [],
        {"orders": M.rows(), "customers": M.distinct("customer_unique_id")},
        through=("customer_unique_id",),
    )
    newest = mart.items("ingested_date").agg(F.max("ingested_date").alias("day"))
    counts = volume.select(F.struct("orders", "customers").alias("v")).scalar()
    return trend.select(
        "*",
        counts.getField("orders").alias("total_orders_ingested"),
        counts.getField("customers").alias("total_customers_ingested"),
        newest.scalar().alias("last_ingest_date"),
    )


@_query
def q5_3_null_impact(mart: Mart) -> DataFrame:
    return (
        mart.table("data_quality_report")
        .orderBy(F.desc("missing_pct"), "column_name")
        .select(
            "column_name",
            "missing_count",
            "total_rows",
            _r("missing_pct", 2, "pct"),
            L.above(F.col("missing_pct"), L.NULL_IMPACT).alias("impact_level"),
        )
    )


# ------------------------------------------------------------------ tab 6: deep analysis


@_query
def q6_1_lifetime_value(mart: Mart) -> DataFrame:
    return (
        mart.table("customer_loyalty_rfm")
        .groupBy("loyalty_tier")
        .agg(
            F.count("*").alias("total_customers"),
            _average_money("total_spend", 2).alias("avg_clv"),
            F.round(F.avg("total_orders"), 1).alias("avg_orders"),
            F.round(F.avg("avg_review_score"), 2).alias("avg_review"),
            F.round(F.avg("recency_days"), 0).alias("avg_recency"),
        )
        .orderBy(F.desc("avg_clv"), "loyalty_tier")
    )


@_query
def q6_2_comments(mart: Mart) -> DataFrame:
    message = F.col("review_comment_message")
    silent = message.isNull() | message.isin("", L.MISSING)
    rows = _bucketed(
        _reviewed(mart, "review_comment_message"),
        "comment_status",
        F.when(silent, L.WITHOUT_COMMENT).otherwise(L.WITH_COMMENT),
        avg_review=M.mean("review_score"),
        negative_pct=_score_percents()["negative_pct"],
    )
    return _rounded(rows, avg_review=2)


@_query
def q6_3_monthly_scores(mart: Mart) -> DataFrame:
    months = M.roll_up(
        _by_month(mart).filter(_score().isNotNull()),
        ["month"],
        {
            "avg_review": M.mean("review_score"),
            "total_orders": M.rows(),
            **_score_percents(),
        },
    )
    return (
        _rounded(months, avg_review=3)
        .filter(F.col("total_orders") >= ENOUGH_ORDERS)
        .orderBy("month")
    )


# Names of the four factors.
_FACTORS = {
    "Late Delivery": "late",
    "High Freight (>30)": "dear",
    "Slow Approval (>24h)": "slow",
    "Heavy Product (>5kg)": "heavy",
}


@_query
def q6_4_root_causes(mart: Mart) -> DataFrame:
    """All factors out of one roll-up, then one row per factor."""
    reviewed = mart.lines(
        [],
        "review_score",
        "is_late_delivery",
        "approval_delay_hours",
        "product_weight_g",
        dear=F.col("freight_value") > L.HIGH_FREIGHT,
        heavy=F.col("product_weight_g") > L.HEAVY_GRAMS,
    ).filter(_score().isNotNull())
    flagged = reviewed.withColumns(
        {
            "late": F.col("is_late_delivery") == 1,
            "slow": F.col("approval_delay_hours") > L.SLOW_APPROVAL_HOURS,
        }
    )
    row = M.roll_up(
        flagged,
        [],
        {
            f"{flag}_{name}": measure
            for flag in _FACTORS.values()
            for name, measure in {
                "hit": M.mean("review_score", F.col(flag), f"{flag}_hit"),
                "free": M.mean("review_score", ~F.col(flag), f"{flag}_free"),
                "n": M.hits(F.col(flag), flag),
            }.items()
        },
    )
    factors = F.array(
        *[
            F.struct(
                F.lit(name).alias("factor"),
                *[F.col(f"{flag}_{part}").alias(part) for part in ("hit", "free", "n")],
            )
            for name, flag in _FACTORS.items()
        ]
    )
    return row.select(F.inline(factors)).select(
        "factor",
        _r("hit", 2, "avg_review_affected"),
        _r("free", 2, "avg_review_unaffected"),
        F.round(F.col("free") - F.col("hit"), 2).alias("impact_delta"),
        F.col("n").alias("affected_orders"),
    )


def _negative_keywords(mart: Mart) -> DataFrame:
    return mart.table("tfidf_review_keywords").filter(F.col("review_bucket") == "negative")


@_query
def q6_5_keywords(mart: Mart) -> DataFrame:
    return (
        _negative_keywords(mart)
        .orderBy(F.desc("tfidf_score"), "keyword")
        .limit(20)
        .select(
            "keyword",
            "review_bucket",
            _r("tfidf_score", 4),
            _r("log_odds", 3),
            "freq_negative",
            "freq_positive",
            "total_docs",
        )
    )


@_query
def q6_6_log_odds(mart: Mart) -> DataFrame:
    return (
        _negative_keywords(mart)
        .filter((F.col("freq_negative") >= 10) & (F.col("total_docs") >= 10))
        .orderBy(F.desc("log_odds"), "keyword")
        .limit(20)
        .select("keyword", _r("log_odds", 3), "freq_negative", "freq_positive", "total_docs")
    )


# ------------------------------------------------------------------ tab 7: stagnation


def _busy_months(mart: Mart) -> DataFrame:
    return mart.table("monthly_review_trend").filter(F.col("total_orders") >= ENOUGH_ORDERS)


@_query
def q7_1_evolution(mart: Mart) -> DataFrame:
    return (
        _busy_months(mart)
        .select(
            "year_month",
            _r("avg_review_score", 3, "avg_review"),
            "total_reviews",
            "total_orders",
            _r("positive_review_pct", 1, "positive_pct"),
            _r("negative_review_pct", 1, "negative_pct"),
            _r("neutral_review_pct", 1, "neutral_pct"),
        )
        .orderBy("year_month")
    )


@_query
def q7_2_composition(mart: Mart) -> DataFrame:
    return q7_1_evolution(mart).select("year_month", "positive_pct", "neutral_pct", "negative_pct")


@_query
def q7_3_late_and_score(mart: Mart) -> DataFrame:
    return (
        _busy_months(mart)
        .select(
            "year_month",
            _r("avg_review_score", 2, "avg_review"),
            _r("late_delivery_pct", 1),
            _r("avg_delivery_delay_days", 1, "avg_delay_days"),
            _r("avg_freight_value", 2, "avg_freight"),
        )
        .orderBy("year_month")
    )


@_query
def q7_4_factor_matrix(mart: Mart) -> DataFrame:
    return (
        mart.table("review_root_cause_matrix")
        .orderBy("avg_review_score", "is_late", "is_high_freight", "is_slow_approval")
        .select(
            F.col("is_late").alias("late_delivery"),
            F.col("is_high_freight").alias("high_freight"),
            F.col("is_slow_approval").alias("slow_approval"),
            "total_orders",
            _r("avg_review_score", 2, "avg_review"),
            _r("negative_review_pct", 1, "negative_pct"),
            _r("positive_review_pct", 1, "positive_pct"),
            F.col("factor_count").alias("num_factors"),
        )
    )


@_query
def q7_5_factor_counts(mart: Mart) -> DataFrame:
    def weighted(name: str) -> Column:
        return F.try_divide(
            F.sum(F.col(name) * F.col("total_orders")), F.sum("total_orders").cast("double")
        )

    groups = F.array(*[F.lit(name) for name in L.FACTOR_GROUPS])
    return (
        mart.table("review_root_cause_matrix")
        .groupBy("factor_count")
        .agg(
            F.sum("total_orders").alias("total_orders_sum"),
            F.round(weighted("avg_review_score"), 2).alias("weighted_avg_review"),
            F.round(weighted("negative_review_pct"), 1).alias("weighted_negative_pct"),
        )
        .withColumn("factor_group", F.get(groups, F.col("factor_count")))
        .orderBy("factor_count")
    )


@_query
def q7_6_worst_routes(mart: Mart) -> DataFrame:
    return (
        mart.table("seller_state_review")
        .filter(F.col("total_orders") >= 20)
        .orderBy("avg_review_score", "seller_state", "customer_state")
        .limit(30)
        .select(
            "seller_state",
            "customer_state",
            "is_same_state",
            "total_orders",
            _r("avg_review_score", 2, "avg_review"),
            _r("avg_shipping_days", 1),
            _r("late_delivery_pct", 1, "late_pct"),
        )
    )


def _busy_score_months(mart: Mart) -> DataFrame:
    return mart.table("review_score_shift").filter(F.col("month_total") >= ENOUGH_ORDERS)


@_query
def q7_7_score_shares(mart: Mart) -> DataFrame:
    return (
        _busy_score_months(mart)
        .select("year_month", "review_score", "total_count", "month_total", _r("score_pct", 1))
        .orderBy("year_month", "review_score")
    )


@_query
def q7_8_polarisation(mart: Mart) -> DataFrame:
    count = F.col("total_count")

    def reviews(*scores: int) -> Column:
        return F.sum(F.when(_score().isin(*scores), count).otherwise(F.lit(0).cast("long")))

    def pct(*scores: int) -> Column:
        return F.round(reviews(*scores) * F.lit(100.0) / F.sum(count), 1)

    return (
        _busy_score_months(mart)
        .groupBy("year_month")
        .agg(
            reviews(1, 5).alias("extreme_count"),
            F.sum(count).alias("total_count_sum"),
            pct(1, 5).alias("polarization_index"),
            pct(5).alias("five_star_pct"),
            pct(1).alias("one_star_pct"),
        )
        .orderBy("year_month")
    )


# ------------------------------------------------------------------ tab 8: projections


def _scenarios(mart: Mart) -> DataFrame:
    return mart.table("simulation_scenarios")


@_query
def q8_1_comparison(mart: Mart) -> DataFrame:
    return (
        _scenarios(mart)
        .select(
            "scenario_id",
            "scenario_name",
            _r("baseline_avg_review", 3, "baseline_review"),
            _r("projected_avg_review", 3, "projected_review"),
            _r("review_delta", 3),
            _r("review_improvement_pct", 1, "improvement_pct"),
            "affected_orders",
            _r("affected_pct", 1),
            _r("ci_lower_95", 3, "ci_lower"),
            _r("ci_upper_95", 3, "ci_upper"),
            "model_type",
        )
        .orderBy("scenario_id")
    )


@_query
def q8_2_affected(mart: Mart) -> DataFrame:
    return (
        _scenarios(mart)
        .select(
            "scenario_id",
            "scenario_name",
            "total_orders",
            "affected_orders",
            (F.col("total_orders") - F.col("affected_orders")).alias("unaffected_orders"),
            _r("affected_pct", 1),
            F.round(F.lit(100.0) - F.col("affected_pct"), 1).alias("unaffected_pct"),
        )
        .orderBy(F.desc("affected_orders"), "scenario_id")
    )


@_query
def q8_3_revenue(mart: Mart) -> DataFrame:
    return (
        _scenarios(mart)
        .filter(F.col("review_delta") > 0)
        .orderBy(F.desc("revenue_impact_est_brl"), "scenario_id")
        .select(
            "scenario_id",
            "scenario_name",
            "additional_orders_est",
            _r("revenue_impact_est_brl", 2, "revenue_impact_brl"),
            _r("review_delta", 3),
            _r("affected_pct", 1),
            L.above(F.col("revenue_impact_est_brl"), L.ROI_LEVELS).alias("roi_level"),
        )
    )


@_query
def q8_4_fewer_negatives(mart: Mart) -> DataFrame:
    return (
        _scenarios(mart)
        .select(
            "scenario_id",
            "scenario_name",
            _r("baseline_negative_pct", 1),
            _r("projected_negative_pct", 1),
            _r("negative_delta", 1, "negative_reduction"),
            _r("baseline_positive_pct", 1),
            _r("projected_positive_pct", 1),
            _r("positive_delta", 1, "positive_gain"),
        )
        .orderBy("negative_reduction", "scenario_id")
    )


@_query
def q8_5_drivers(mart: Mart) -> DataFrame:
    return (
        mart.table("simulation_feature_impact")
        .orderBy(F.desc("importance_pct"), "feature_label")
        .select(
            "feature_label",
            _r("importance_pct", 2),
            _r("model_r2", 3),
            L.from_(F.col("importance_pct"), L.DRIVER_LEVELS).alias("driver_level"),
        )
    )
