"""The materialised aggregates, one function per warehouse table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.functions import labels as L
from cartpulse.functions import measures as M
from cartpulse.functions.times import year_month
from cartpulse.operators import keywords, models
from cartpulse.operators.fact import of_orders
from cartpulse.operators.imputation import audit, impute, timestamps_to_text
from cartpulse.plans.mart import LiveMart, Mart
from cartpulse.sources import scratch

CATEGORY = "product_category_name_english"
# Items that are joined for each one a forest learns from, at first and then times so many.
FEW_ITEMS, MORE_ITEMS = 4, 8


def _late() -> Column:
    return F.col("is_late_delivery") == 1


def _on_time() -> Column:
    return F.col("is_late_delivery") == 0


def _score() -> Column:
    return F.col("review_score")


def _late_share() -> M.Measure:
    return M.share(_late(), "late")


def _score_shares() -> dict[str, M.Measure]:
    return {
        "positive_review_pct": M.share(L.positive(_score()), "positive"),
        "negative_review_pct": M.share(L.negative(_score()), "negative"),
        "neutral_review_pct": M.share(_score() == 3, "neutral"),
    }


def _today(mart: Mart) -> Column:
    day = F.current_date() if mart.ingested_date is None else F.lit(mart.ingested_date)
    return day.cast("string")


def order_items(mart: Mart) -> DataFrame:
    from cartpulse.schemas import FACT

    fact = mart.items(*FACT.fieldNames()).select(*FACT.fieldNames())
    return timestamps_to_text(fact)


def data_quality_report(mart: Mart) -> DataFrame:
    from cartpulse.operators.imputation import AUDITED_COLUMNS

    return audit(mart.raw_items(*AUDITED_COLUMNS), ingested_date=mart.ingested_date)


def category_summary(mart: Mart) -> DataFrame:
    return M.roll_up(
        mart.lines([CATEGORY], "review_score"),
        [CATEGORY],
        {
            "total_orders": M.rows(),
            "total_revenue": M.total("price"),
            "total_items": M.items(),
            "avg_review_score": M.mean("review_score"),
            "avg_price": M.mean_money("price"),
            "avg_freight": M.mean_money("freight"),
        },
    )


def top_products(mart: Mart) -> DataFrame:
    return mart.table("category_summary").drop("avg_freight")


def hourly_activity(mart: Mart) -> DataFrame:
    return _hourly(mart, total_items=M.items())


def _hourly(mart: Mart, **extra: M.Measure) -> DataFrame:
    return M.roll_up(
        mart.orders("order_hour_of_day").withColumnRenamed("order_hour_of_day", "order_hour"),
        ["order_hour"],
        {"total_orders": M.rows(), "total_revenue": M.total("price"), **extra},
    )


def review_analysis(mart: Mart) -> DataFrame:
    reviewed = mart.lines(
        [CATEGORY], "review_score", "delivery_delay_days", "is_late_delivery"
    ).filter(_score().isNotNull())
    return M.roll_up(
        reviewed,
        [CATEGORY],
        {
            "total_reviews": M.items(),
            "avg_review_score": M.mean("review_score"),
            **_score_shares(),
            "avg_delivery_delay_days": M.mean_days("delivery_delay_days"),
            "late_delivery_pct": _late_share(),
            "avg_freight_value": M.mean_money("freight"),
            "avg_price": M.mean_money("price"),
        },
    )


def _delivered_only(orders: DataFrame, wanted: bool) -> DataFrame:
    return orders.filter(F.col("delivery_delay_days").isNotNull()) if wanted else orders


def delivery_performance(mart: Mart, delivered_only: bool = False) -> DataFrame:
    """Per customer state. Undelivered orders count as on time unless left out."""
    orders = mart.orders(
        "customer_state",
        "shipping_duration_days",
        "delivery_delay_days",
        "is_late_delivery",
        "review_score",
    )
    return M.roll_up(
        _delivered_only(orders, delivered_only),
        ["customer_state"],
        {
            "total_orders": M.rows(),
            "avg_delivery_days": M.mean_days("shipping_duration_days"),
            "avg_delay_days": M.mean_days("delivery_delay_days"),
            "on_time_pct": M.share(_on_time(), "on_time"),
            "late_delivery_pct": _late_share(),
            "avg_review_when_late": M.mean("review_score", _late(), "late"),
            "avg_review_when_ontime": M.mean("review_score", _on_time(), "on_time"),
            "avg_freight_value": M.mean_money("freight"),
        },
    )


def seller_performance(mart: Mart) -> DataFrame:
    seller = ["seller_id", "seller_city", "seller_state"]
    return M.roll_up(
        mart.lines(seller, "review_score", "shipping_duration_days", "is_late_delivery"),
        seller,
        {
            "total_orders": M.rows(),
            "total_revenue": M.total("price"),
            "avg_review_score": M.mean("review_score"),
            "avg_delivery_days": M.mean_days("shipping_duration_days"),
            "late_delivery_pct": _late_share(),
            "total_products_sold": M.items(),
        },
    )


def loyalty_rfm(mart: Mart, once_per_order: bool = False) -> DataFrame:
    """Recency, frequency, monetary value, tier and churn risk per customer.

    Recency counts from the newest purchase in the data. The payment of an order
    counts once per item, or once per order on request.
    """
    orders = mart.orders(
        "customer_unique_id", "order_purchase_timestamp", "payment_value", "review_score"
    )
    dated = mart.orders("order_purchase_timestamp").withColumn(
        "purchase_date", F.to_date("order_purchase_timestamp")
    )
    newest = M.roll_up(dated, [], {"newest": M.greatest("purchase_date")}).scalar()
    customers = M.roll_up(
        orders,
        ["customer_unique_id"],
        {
            "total_orders": M.rows(),
            "total_spend": M.payment_total(once_per_order),
            "avg_review_score": M.mean("review_score"),
            "first_order_date": M.least("order_purchase_timestamp"),
            "last_order_date": M.greatest("order_purchase_timestamp"),
        },
    )
    recency = F.col("recency_days")
    return customers.withColumn(
        "recency_days", F.date_diff(newest, F.to_date("last_order_date"))
    ).withColumns(
        {
            "frequency": F.col("total_orders"),
            "monetary": F.col("total_spend"),
            "loyalty_tier": F.when(F.col("total_orders") >= 3, L.LOYALTY_TIERS[0])
            .when(F.col("total_orders") == 2, L.LOYALTY_TIERS[1])
            .otherwise(L.LOYALTY_TIERS[2]),
            "churn_risk": F.when(recency > 60, L.CHURN_RISKS[0])
            .when(recency > 30, L.CHURN_RISKS[1])
            .otherwise(L.CHURN_RISKS[2]),
        }
    )


def customer_loyalty_rfm(mart: Mart) -> DataFrame:
    return models.with_clusters(timestamps_to_text(loyalty_rfm(mart)))


def geographic_analysis(mart: Mart) -> DataFrame:
    return M.roll_up(
        mart.orders(
            "customer_state",
            "customer_city",
            "customer_unique_id",
            "review_score",
            "shipping_duration_days",
            "is_late_delivery",
        ),
        ["customer_state", "customer_city"],
        {
            "total_orders": M.rows(),
            "total_revenue": M.total("price"),
            "avg_review_score": M.mean("review_score"),
            "avg_delivery_days": M.mean_days("shipping_duration_days"),
            "avg_freight_value": M.mean_money("freight"),
            "total_customers": M.distinct("customer_unique_id"),
            "late_delivery_pct": _late_share(),
        },
        through=("customer_unique_id",),
    )


def state_totals(mart: Mart) -> DataFrame:
    """Orders, revenue, score and customers per customer state (cities rolled up)."""
    return M.roll_up(
        mart.orders("customer_state", "customer_unique_id", "review_score"),
        ["customer_state"],
        {
            "total_orders": M.rows(),
            "total_revenue": M.total("price"),
            "avg_review_score": M.mean("review_score"),
            "total_customers": M.distinct("customer_unique_id"),
        },
        through=("customer_unique_id",),
    )


def payment_analysis(mart: Mart, once_per_order: bool = False) -> DataFrame:
    orders = mart.orders("payment_type", "payment_value", "payment_installments", "review_score")
    return M.roll_up(
        orders,
        ["payment_type"],
        {
            "total_orders": M.rows(),
            "total_revenue": M.payment_total(once_per_order),
            "avg_payment_value": M.payment_mean(once_per_order),
            "avg_installments": M.mean("payment_installments"),
            "avg_review_score": M.mean("review_score"),
        },
    )


def sales_forecasting(mart: Mart) -> DataFrame:
    """Demand projection from the share of repeat customers.

    Orders, customers and repeat customers of a category come out of one chain of
    roll-ups (order, then customer, then category); no join is needed.
    """
    growth = F.col("growth_rate")
    base = M.roll_up(
        mart.lines([CATEGORY], "customer_unique_id"),
        [CATEGORY],
        {
            "current_total_orders": M.rows(),
            "current_total_revenue": M.total("price"),
            "avg_order_value": M.mean_money("price"),
            "customers": M.distinct("customer_unique_id"),
            "repeaters": M.count_where(F.col("rows") > 1, "repeaters"),
        },
        through=("customer_unique_id",),
    )
    return (
        base.withColumn(
            "growth_rate",
            F.coalesce(
                F.round(F.try_divide(F.col("repeaters"), F.col("customers")), 4), F.lit(0.0)
            ),
        )
        .withColumns(
            {
                "forecasted_orders": F.round(F.col("current_total_orders") * (growth + 1), 2),
                "forecasted_revenue": F.round(F.col("current_total_revenue") * (growth + 1), 2),
                "risk_level": F.when(growth < 0, "High Risk")
                .when(growth <= 0.3, "Medium")
                .otherwise("Low Risk"),
            }
        )
        .drop("customers", "repeaters")
    )


def history_category_trend(mart: Mart, batch_time: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if batch_time is None else batch_time
    return (
        mart.table("category_summary")
        .select(CATEGORY, "total_orders", "total_revenue", "avg_review_score")
        .withColumns({"batch_time": stamp, "ingested_date": _today(mart)})
    )


def daily_summary(mart: Mart) -> DataFrame:
    totals = M.roll_up(
        mart.orders("customer_unique_id", "review_score", "is_late_delivery", "delivery_delay_days"),
        [],
        {
            "total_orders": M.rows(),
            "total_revenue": M.total("price"),
            "avg_basket_size": M.basket(M.rows()),
            "avg_review_score": M.mean("review_score"),
            "total_customers": M.distinct("customer_unique_id"),
            "on_time_delivery_pct": M.share(_on_time(), "on_time"),
            "late_delivery_count": M.hits(_late(), "late"),
            "avg_delivery_delay_days": M.mean_days("delivery_delay_days"),
        },
        through=("customer_unique_id",),
    )
    return totals.withColumns({"summary_date": _today(mart), "ingested_date": _today(mart)})


def products_performance(mart: Mart) -> DataFrame:
    return M.roll_up(
        mart.lines(["product_id", CATEGORY], "customer_unique_id", "review_score"),
        ["product_id", CATEGORY],
        {
            "total_orders": M.rows(),
            "total_revenue": M.total("price"),
            "avg_price": M.mean_money("price"),
            "avg_freight": M.mean_money("freight"),
            "avg_review_score": M.mean("review_score"),
            "total_unique_buyers": M.distinct("customer_unique_id"),
        },
        through=("customer_unique_id",),
    )


def hourly_capacity(mart: Mart) -> DataFrame:
    # at most 24 rows reach the unpartitioned window
    busiest = F.max("total_orders").over(Window.partitionBy())
    used = F.round(F.try_divide(F.col("total_orders"), busiest) * F.lit(100.0), 2)
    usage = F.col("capacity_utilization_pct")
    return (
        _hourly(mart, avg_items_per_order=M.basket(M.rows()))
        .withColumn("capacity_utilization_pct", F.coalesce(used, F.lit(0.0)))
        .withColumn(
            "peak_label",
            F.when(usage > 80, "Peak").when(usage >= 50, "Normal").otherwise("Off-Peak"),
        )
    )


def feature_importances(mart: Mart) -> DataFrame:
    return models.driver_importances(mart.items("review_score", *models.DRIVERS))


def review_texts(mart: Mart, keep_sentinel: bool = False) -> DataFrame:
    """One row per order with a review text; ``n_items`` is the weight of the text."""
    orders = mart.orders("review_score", "review_comment_message").filter(_score().isNotNull())
    if not keep_sentinel:
        orders = orders.filter(F.col("review_comment_message") != L.MISSING)
    weight = M.signed("n_items", orders).alias("n_items")
    return orders.select("order_id", "review_score", "review_comment_message", weight)


def top_bad_review_words(
    mart: Mart, max_score: int = 2, keep_sentinel: bool = False, top: int = 20
) -> DataFrame:
    return keywords.frequent_words(review_texts(mart, keep_sentinel), max_score, top)


def _dated_reviews(mart: Mart, *columns: str) -> DataFrame:
    return (
        mart.orders("order_purchase_timestamp", "review_score", *columns)
        .filter(_score().isNotNull() & F.col("order_purchase_timestamp").isNotNull())
        .withColumn("year_month", year_month(F.col("order_purchase_timestamp")))
    )


def monthly_review_trend(mart: Mart) -> DataFrame:
    return M.roll_up(
        _dated_reviews(mart, "is_late_delivery", "delivery_delay_days"),
        ["year_month"],
        {
            "total_reviews": M.items(),
            "avg_review_score": M.mean("review_score"),
            **_score_shares(),
            "late_delivery_pct": _late_share(),
            "avg_delivery_delay_days": M.mean_days("delivery_delay_days"),
            "avg_freight_value": M.mean_money("freight"),
            "total_orders": M.rows(),
        },
    )


def review_root_cause_matrix(mart: Mart) -> DataFrame:
    causes = ["is_late", "is_high_freight", "is_slow_approval"]
    reviewed = (
        mart.lines(
            [],
            "review_score",
            "is_late_delivery",
            "approval_delay_hours",
            is_high_freight=L.yes_no(F.col("freight_value") > L.HIGH_FREIGHT),
        )
        .filter(_score().isNotNull())
        .withColumns(
            {
                "is_late": L.yes_no(_late()),
                "is_slow_approval": L.yes_no(
                    F.col("approval_delay_hours") > L.SLOW_APPROVAL_HOURS
                ),
            }
        )
    )
    shares = _score_shares()
    cells = M.roll_up(
        reviewed,
        causes,
        {
            "total_orders": M.rows(),
            "avg_review_score": M.mean("review_score"),
            "negative_review_pct": shares["negative_review_pct"],
            "positive_review_pct": shares["positive_review_pct"],
        },
    )
    # the count follows from the keys
    present = [(F.col(name) == "Yes").cast("int") for name in causes]
    return cells.withColumn("factor_count", present[0] + present[1] + present[2])


def seller_state_review(mart: Mart) -> DataFrame:
    seller, customer = F.col("seller_state"), F.col("customer_state")
    routed = mart.lines(
        ["seller_state"],
        "customer_state",
        "review_score",
        "shipping_duration_days",
        "is_late_delivery",
    ).filter((seller != L.MISSING) & (customer != L.MISSING) & _score().isNotNull())
    return M.roll_up(
        routed,
        ["seller_state", "customer_state"],
        {
            "total_orders": M.rows(),
            "avg_review_score": M.mean("review_score"),
            "avg_shipping_days": M.mean_days("shipping_duration_days"),
            "late_delivery_pct": _late_share(),
        },
    ).withColumn(
        "is_same_state",
        F.when(seller == customer, F.lit(L.SAME_STATE)).otherwise(F.lit(L.OTHER_STATE)),
    )


def monthly_delivery_accuracy(mart: Mart, delivered_only: bool = False) -> DataFrame:
    orders = (
        mart.orders(
            "order_purchase_timestamp",
            "is_late_delivery",
            "delivery_delay_days",
            "shipping_duration_days",
            "review_score",
        )
        .filter(F.col("order_purchase_timestamp").isNotNull())
        .withColumn("year_month", year_month(F.col("order_purchase_timestamp")))
    )
    return M.roll_up(
        _delivered_only(orders, delivered_only),
        ["year_month"],
        {
            "total_delivered": M.items(),
            "on_time_pct": M.share(_on_time(), "on_time"),
            "late_pct": _late_share(),
            "avg_delay_days": M.mean_days("delivery_delay_days"),
            "avg_shipping_days": M.mean_days("shipping_duration_days"),
            "avg_review_when_late": M.mean("review_score", _late(), "late"),
            "avg_review_when_ontime": M.mean("review_score", _on_time(), "on_time"),
        },
    ).withColumn("review_gap", F.col("avg_review_when_ontime") - F.col("avg_review_when_late"))


def review_score_shift(mart: Mart) -> DataFrame:
    counts = M.roll_up(
        _dated_reviews(mart), ["year_month", "review_score"], {"total_count": M.items()}
    )
    month = F.sum("total_count").over(Window.partitionBy("year_month"))
    return counts.withColumn("month_total", month).withColumn(
        "score_pct", F.round(F.col("total_count") / F.col("month_total") * F.lit(100.0), 2)
    )


def tfidf_review_keywords(mart: Mart) -> DataFrame:
    return keywords.top_keywords(keywords.review_corpus(review_texts(mart)))


def simulation_scenarios(mart: Mart) -> DataFrame:
    from cartpulse.operators import whatif

    return whatif.forest_summary(whatif.prepare(mart.items("review_score", *whatif.SOURCES)))


def first_labelled(mart: Mart, *columns: str, count: int) -> DataFrame:
    """Clean item rows, among them the ``count`` reviewed ones first by a hash of their key.

    For a forest that is told to learn from so many. Where rows would have to be joined, the keys
    are read first, and only orders with a hash in the lowest part of the range are joined:
    four times as many items as are wanted, eight times as many again while too few of them
    have a review, all rows in the end.
    """
    if not isinstance(mart, LiveMart):
        return mart.items(*columns)
    items = mart.inputs.order_items
    place = models.sample_place(["order_id", *columns])
    keys = impute(items.select("order_id", "order_item_id")).withColumn("place", place)
    share = FEW_ITEMS * count / max(items.count(), 1)
    while share < 1:
        first = F.col("place") <= int(-(2**63) + share * 2**64)
        ids = keys.filter(first).select("order_id").distinct()
        few = LiveMart(of_orders(mart.inputs, ids), mart.ingested_date).items(*columns)
        folder = scratch.new_folder(items.sparkSession, "labelled")
        few.withColumn("place", place).filter(first).drop("place").write.parquet(folder)
        found = items.sparkSession.read.schema(few.schema).parquet(folder)
        if found.filter(F.col("review_score").isNotNull()).count() >= count:
            return found
        share *= MORE_ITEMS
    return mart.items(*columns)


def simulation_feature_impact(mart: Mart) -> DataFrame:
    from cartpulse.operators import whatif

    return whatif.feature_impact(whatif.prepare(mart.items("review_score", *whatif.SOURCES)))


BUILDERS: dict[str, Callable[[Mart], DataFrame]] = {
    builder.__name__: builder
    for builder in (
        order_items,
        data_quality_report,
        top_products,
        category_summary,
        hourly_activity,
        review_analysis,
        delivery_performance,
        seller_performance,
        customer_loyalty_rfm,
        geographic_analysis,
        payment_analysis,
        sales_forecasting,
        history_category_trend,
        daily_summary,
        products_performance,
        hourly_capacity,
        feature_importances,
        top_bad_review_words,
        monthly_review_trend,
        review_root_cause_matrix,
        seller_state_review,
        monthly_delivery_accuracy,
        review_score_shift,
        tfidf_review_keywords,
        simulation_scenarios,
        simulation_feature_impact,
    )
}
