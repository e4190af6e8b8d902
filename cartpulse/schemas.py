"""Column contracts of the eight inputs, the item-grain fact and the warehouse tables.

The names and types below are fixed values: queries written against the
warehouse rely on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _contract(columns: str) -> T.StructType:
    # needs no session, unlike StructType.fromDDL
    contract = T.StructType()
    for column in columns.split(","):
        name, kind = column.split()
        contract.add(name, _TYPES[kind])
    return contract


# ---------------------------------------------------------------- inputs (fixed values)

INPUTS: dict[str, T.StructType] = {
    "orders": _contract(
        "order_id string, customer_id string, order_status string,"
        " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
        " order_delivered_carrier_date timestamp_ntz,"
        " order_delivered_customer_date timestamp_ntz,"
        " order_estimated_delivery_date timestamp_ntz"
    ),
    "order_items": _contract(
        "order_id string, order_item_id int, product_id string, seller_id string,"
        " price double, freight_value double"
    ),
    "products": _contract(
        "product_id string, product_category_name string, product_weight_g double,"
        " product_length_cm double, product_height_cm double, product_width_cm double"
    ),
    "customers": _contract(
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int,"
        " customer_city string, customer_state string"
    ),
    "sellers": _contract(
        "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
    ),
    "order_payments": _contract(
        "order_id string, payment_sequential int, payment_type string,"
        " payment_installments int, payment_value double"
    ),
    "order_reviews": _contract(
        "review_id string, order_id string, review_score int,"
        " review_comment_message string, review_creation_date timestamp_ntz"
    ),
    "category_translation": _contract(
        "product_category_name string, product_category_name_english string"
    ),
}

# ------------------------------------------------------ item-grain fact (fixed values)

FACT = _contract(
    "order_id string, customer_id string, customer_unique_id string, order_item_id int,"
    " product_id string, seller_id string, order_status string,"
    " order_purchase_timestamp string, order_approved_at string,"
    " order_delivered_carrier_date string, order_delivered_customer_date string,"
    " order_estimated_delivery_date string,"
    " customer_city string, customer_state string, customer_zip_code_prefix int,"
    " seller_city string, seller_state string, seller_zip_code_prefix int,"
    " product_category_name string, product_category_name_english string,"
    " product_weight_g double, price double, freight_value double, total_item_value double,"
    " payment_type string, payment_installments int, payment_value double,"
    " review_score int, review_comment_message string,"
    " delivery_delay_days double, shipping_duration_days double, approval_delay_hours double,"
    " is_late_delivery int, order_hour_of_day int, order_day_of_week int,"
    " ingested_date string"
)

# ------------------------------------------------------- warehouse tables (fixed values)

_TREND = (
    "product_category_name_english string, total_orders bigint, total_revenue double,"
    " avg_review_score double, batch_time timestamp, ingested_date string"
)

TABLES: dict[str, T.StructType] = {
    "orders_db.order_items": FACT,
    "orders_db.top_products": _contract(
        "product_category_name_english string, total_orders bigint, total_revenue double,"
        " avg_price double, avg_review_score double, total_items bigint"
    ),
    "orders_db.category_summary": _contract(
        "product_category_name_english string, total_orders bigint, total_revenue double,"
        " total_items bigint, avg_review_score double, avg_price double, avg_freight double"
    ),
    "orders_db.hourly_activity": _contract(
        "order_hour int, total_orders bigint, total_items bigint, total_revenue double"
    ),
    "orders_db.daily_summary": _contract(
        "summary_date string, total_orders bigint, total_revenue double,"
        " avg_basket_size double, avg_review_score double, total_customers bigint,"
        " on_time_delivery_pct double, late_delivery_count bigint,"
        " avg_delivery_delay_days double, ingested_date string"
    ),
    "orders_db.data_quality_report": _contract(
        "ingested_date string, column_name string, total_rows bigint,"
        " missing_count bigint, missing_pct double"
    ),
    "orders_db.history_category_trend": _contract(_TREND),
    "analytics.history_category_trend": _contract(_TREND),
    "analytics.review_analysis": _contract(
        "product_category_name_english string, total_reviews bigint, avg_review_score double,"
        " positive_review_pct double, negative_review_pct double, neutral_review_pct double,"
        " avg_delivery_delay_days double, late_delivery_pct double, avg_freight_value double,"
        " avg_price double"
    ),
    "analytics.delivery_performance": _contract(
        "customer_state string, total_orders bigint, avg_delivery_days double,"
        " avg_delay_days double, on_time_pct double, late_delivery_pct double,"
        " avg_review_when_late double, avg_review_when_ontime double, avg_freight_value double"
    ),
    "analytics.seller_performance": _contract(
        "seller_id string, seller_city string, seller_state string, total_orders bigint,"
        " total_revenue double, avg_review_score double, avg_delivery_days double,"
        " late_delivery_pct double, total_products_sold bigint"
    ),
    "analytics.customer_loyalty_rfm": _contract(
        "customer_unique_id string, total_orders bigint, total_spend double,"
        " avg_review_score double, first_order_date string, last_order_date string,"
        " recency_days int, frequency bigint, monetary double, loyalty_tier string,"
        " churn_risk string, kmeans_cluster string"
    ),
    "analytics.geographic_analysis": _contract(
        "customer_state string, customer_city string, total_orders bigint,"
        " total_revenue double, avg_review_score double, avg_delivery_days double,"
        " avg_freight_value double, total_customers bigint, late_delivery_pct double"
    ),
    "analytics.payment_analysis": _contract(
        "payment_type string, total_orders bigint, total_revenue double,"
        " avg_payment_value double, avg_installments double, avg_review_score double"
    ),
    "analytics.sales_forecasting": _contract(
        "product_category_name_english string, current_total_orders bigint,"
        " current_total_revenue double, avg_order_value double, growth_rate double,"
        " forecasted_orders double, forecasted_revenue double, risk_level string"
    ),
    "analytics.products_performance": _contract(
        "product_id string, product_category_name_english string, total_orders bigint,"
        " total_revenue double, avg_price double, avg_freight double,"
        " avg_review_score double, total_unique_buyers bigint"
    ),
    "analytics.hourly_capacity": _contract(
        "order_hour int, total_orders bigint, total_revenue double,"
        " avg_items_per_order double, capacity_utilization_pct double, peak_label string"
    ),
    "analytics.feature_importances": _contract("feature_name string, importance_pct double"),
    "analytics.top_bad_review_words": _contract("word string, frequency bigint"),
    "analytics.monthly_review_trend": _contract(
        "year_month string, total_reviews bigint, avg_review_score double,"
        " positive_review_pct double, neutral_review_pct double, negative_review_pct double,"
        " late_delivery_pct double, avg_delivery_delay_days double, avg_freight_value double,"
        " total_orders bigint"
    ),
    "analytics.review_root_cause_matrix": _contract(
        "is_late string, is_high_freight string, is_slow_approval string,"
        " total_orders bigint, avg_review_score double, negative_review_pct double,"
        " positive_review_pct double, factor_count int"
    ),
    "analytics.seller_state_review": _contract(
        "seller_state string, customer_state string, total_orders bigint,"
        " avg_review_score double, avg_shipping_days double, late_delivery_pct double,"
        " is_same_state string"
    ),
    "analytics.monthly_delivery_accuracy": _contract(
        "year_month string, total_delivered bigint, on_time_pct double, late_pct double,"
        " avg_delay_days double, avg_shipping_days double, avg_review_when_late double,"
        " avg_review_when_ontime double, review_gap double"
    ),
    "analytics.review_score_shift": _contract(
        "year_month string, review_score int, total_count bigint, month_total bigint,"
        " score_pct double"
    ),
    "analytics.simulation_scenarios": _contract(
        "scenario_id string, scenario_name string, description string,"
        " solution_recommendation string, total_orders bigint, affected_orders bigint,"
        " affected_pct double, baseline_avg_review double, baseline_positive_pct double,"
        " baseline_negative_pct double, baseline_neutral_pct double,"
        " projected_avg_review double, projected_positive_pct double,"
        " projected_negative_pct double, projected_neutral_pct double, review_delta double,"
        " positive_delta double, negative_delta double, review_improvement_pct double,"
        " ci_lower_95 double, ci_upper_95 double, additional_orders_est bigint,"
        " revenue_impact_est_brl double, model_type string"
    ),
    "analytics.simulation_feature_impact": _contract(
        "feature_name string, feature_label string, importance_pct double, model_r2 double"
    ),
    "analytics.tfidf_review_keywords": _contract(
        "review_bucket string, keyword string, tfidf_score double, log_odds double,"
        " freq_negative bigint, freq_positive bigint, total_docs bigint"
    ),
}
