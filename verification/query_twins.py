"""DuckDB twins of the fifty dashboard queries and of the single operators."""

from __future__ import annotations

import math

from cartpulse.functions import labels as L
from verification import twins as t
from verification.twins import CAT, LATE, NEG, ON_TIME, POS, SCORE, hits, mean, percent, r, ratio

KNOWN = f"{CAT} <> 'missing'"
AVG2 = r("avg_review_score", 2)
N = t.ORDERS


def _top(order: str, limit: int) -> str:
    return f"ORDER BY {order} LIMIT {limit}"


def _steps(column: str, ladder, unknown: str | None = None) -> str:
    whens = [f"WHEN {column} IS NULL THEN '{unknown}'"] if unknown else []
    whens += [f"WHEN {column} <= {limit} THEN '{label}'" for limit, label in ladder[:-1]]
    return f"CASE {' '.join(whens)} ELSE '{ladder[-1][1]}' END"


def _over(column: str, ladder, sign: str = ">") -> str:
    whens = " ".join(f"WHEN {column} {sign} {limit} THEN '{label}'" for limit, label in ladder[:-1])
    return f"CASE {whens} ELSE '{ladder[-1][1]}' END"


def _seller(order: str, extra: str = "") -> str:
    return f"""
SELECT seller_id, seller_city, seller_state, total_orders, {r('total_revenue', 2)} AS revenue,
       {AVG2} AS avg_review, {r('late_delivery_pct', 1)} AS late_pct {extra}
FROM seller_performance WHERE total_orders >= 10 {_top(order, 20)}"""


def _factor(name: str, hit: str, free: str) -> str:
    return f"""
SELECT '{name}' AS factor, {r(mean('review_score', hit), 2)} AS avg_review_affected,
       {r(mean('review_score', free), 2)} AS avg_review_unaffected,
       {r(f"{mean('review_score', free)} - {mean('review_score', hit)}", 2)} AS impact_delta,
       {hits(hit)} AS affected_orders
FROM clean WHERE review_score IS NOT NULL"""


SPEND = "CAST(round(total_spend * 10000) AS BIGINT)"
MEAN_SPEND = r(f"CAST(sum({SPEND}) AS DOUBLE) / (count(*) * 10000)", 2)
PERCENTS = (
    f"{percent(POS, 'review_score IS NOT NULL')} AS positive_pct,"
    f" {percent(NEG, 'review_score IS NOT NULL')} AS negative_pct"
)
EXTREME = {"extreme_count": "1, 5", "five": "5", "one": "1"}


def _counted(scores: str) -> str:
    return f"coalesce(sum(total_count) FILTER (WHERE review_score IN ({scores})), 0)"


def _score_pct(scores: str) -> str:
    return r(ratio(f"({_counted(scores)} * 1e2)", "sum(total_count)"), 1)


QUERIES: dict[str, str] = {
    "q1_1": f"""
SELECT {N} AS total_orders, count(DISTINCT customer_unique_id) AS total_customers,
       count(DISTINCT product_id) AS total_products, {r(t.money('price'), 2)} AS total_revenue,
       {r(ratio('count(*)', N), 1)} AS avg_basket_size, {r(SCORE, 2)} AS avg_review_score,
       {percent(ON_TIME, 'is_late_delivery IS NOT NULL')} AS on_time_delivery_pct
FROM clean""",
    "q1_2": f"""
SELECT {CAT} AS category, total_orders, {r('total_revenue', 2)} AS revenue, {AVG2} AS avg_review
FROM top_products WHERE {KNOWN} {_top(f'top_products.total_revenue DESC, {CAT}', 10)}""",
    "q1_3": f"""
SELECT {CAT} AS category, {r('total_revenue', 2)} AS revenue
FROM category_summary WHERE {KNOWN} {_top('revenue DESC, category', 15)}""",
    "q1_4": """
SELECT review_score, count(*) AS total FROM clean WHERE review_score IS NOT NULL
GROUP BY review_score ORDER BY review_score""",
    "q1_5": f"""
SELECT order_status, {N} AS total_orders FROM clean GROUP BY order_status
ORDER BY total_orders DESC, order_status""",
    "q1_6": f"""
SELECT {t.MONTH} AS month, {N} AS total_orders, {r(t.money('price'), 2)} AS revenue,
       {r(SCORE, 2)} AS avg_review
FROM clean WHERE order_purchase_timestamp IS NOT NULL GROUP BY {t.MONTH} ORDER BY month""",
    "q1_7": f"""
(SELECT {CAT} AS category, total_orders, {r('total_revenue', 2)} AS revenue, {AVG2} AS avg_review,
        'Top Performer' AS label
 FROM category_summary WHERE {KNOWN} {_top(f'category_summary.total_revenue DESC, {CAT}', 3)})
UNION ALL
(SELECT {CAT} AS category, total_orders, {r('total_revenue', 2)} AS revenue, {AVG2} AS avg_review,
        'Bottom Performer' AS label
 FROM category_summary WHERE {KNOWN} AND total_orders >= 10
 {_top(f'category_summary.total_revenue, {CAT}', 3)})""",
    "q2_1": f"""
SELECT order_day_of_week,
       CASE order_day_of_week {' '.join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(L.WEEKDAYS))} END
         AS hari, {N} AS total_orders
FROM clean GROUP BY order_day_of_week ORDER BY order_day_of_week""",
    "q2_2": f"""
SELECT order_hour AS jam, total_orders, total_items, {r('total_revenue', 2)} AS revenue
FROM hourly_activity ORDER BY jam""",
    "q2_3": f"""
SELECT order_hour_of_day AS jam,
       {', '.join(f'{hits(f"order_day_of_week = {i}")} AS {d}' for i, d in enumerate(L.WEEKDAYS))}
FROM clean GROUP BY order_hour_of_day ORDER BY jam""",
    "q2_4": f"""
SELECT {CAT} AS category, total_items, {r('total_revenue', 2)} AS revenue, {AVG2} AS avg_review,
       {r('avg_price', 2)} AS avg_price, {r('avg_freight', 2)} AS avg_freight
FROM category_summary WHERE {KNOWN}""",
    "q2_5": f"""
SELECT payment_type, total_orders, {r('total_revenue', 2)} AS revenue, {AVG2} AS avg_review
FROM payment_analysis WHERE payment_type <> 'missing'""",
    "q2_6": f"""
SELECT {_steps('shipping_duration_days', L.SHIPPING_LADDER, L.SHIPPING_UNKNOWN)} AS delivery_bucket,
       {N} AS total_orders, {r(SCORE, 2)} AS avg_review
FROM clean GROUP BY 1""",
    "q2_7": f"""
SELECT customer_state, total_orders, {r('total_revenue', 2)} AS revenue, {AVG2} AS avg_review,
       total_customers
FROM geographic_analysis WHERE customer_state <> 'missing'
GROUP BY customer_state, total_orders, total_revenue, avg_review_score, total_customers
{_top('total_orders DESC, customer_state, total_revenue', 15)}""",
    "q3_1": f"""
SELECT {_steps('delivery_delay_days', L.DELAY_LADDER, L.DELAY_UNKNOWN)} AS delivery_category,
       {N} AS total_orders, {r(SCORE, 2)} AS avg_review_score, {r(t.mean_days('delay'), 1)} AS avg_delay
FROM clean WHERE review_score IS NOT NULL GROUP BY 1""",
    "q3_2": f"""
SELECT if({LATE}, '{L.LATE}', '{L.ON_TIME}') AS status, {N} AS total_orders,
       {r(SCORE, 2)} AS avg_review_score, {PERCENTS}
FROM clean WHERE is_late_delivery IS NOT NULL AND review_score IS NOT NULL GROUP BY 1""",
    "q3_3": f"""
SELECT {CAT} AS category, total_reviews, {AVG2} AS avg_review,
       {r('negative_review_pct', 1)} AS negative_pct, {r('positive_review_pct', 1)} AS positive_pct,
       {r('late_delivery_pct', 1)} AS late_delivery_pct
FROM review_analysis WHERE {KNOWN} {_top(f'avg_review_score, {CAT}', 15)}""",
    "q3_4": f"""
SELECT loyalty_tier, churn_risk, count(*) AS total_customers, {MEAN_SPEND} AS avg_spend,
       {r('avg(avg_review_score)', 2)} AS avg_review, {r('avg(recency_days)', 0)} AS avg_recency_days
FROM customer_loyalty_rfm GROUP BY loyalty_tier, churn_risk""",
    "q3_5": f"""
SELECT customer_state AS state, total_orders, {r('avg_delivery_days', 1)} AS avg_delivery,
       {r('late_delivery_pct', 1)} AS late_pct, {r('avg_review_when_late', 2)} AS review_when_late,
       {r('avg_review_when_ontime', 2)} AS review_when_ontime,
       {r('avg_review_when_ontime - avg_review_when_late', 2)} AS review_gap
FROM delivery_performance""",
    "q3_6": f"""
SELECT {CAT} AS category, current_total_orders, {r('current_total_revenue', 2)} AS current_revenue,
       {r('forecasted_orders', 0)} AS forecast_orders, {r('forecasted_revenue', 2)} AS forecast_revenue,
       {r('growth_rate * 1e2', 1)} AS growth_pct, risk_level
FROM sales_forecasting WHERE {KNOWN} {_top(f'current_total_revenue DESC, {CAT}', 20)}""",
    "q3_7": f"""
SELECT {_steps('approval_delay_hours', L.APPROVAL_LADDER)} AS approval_bucket, {N} AS total_orders,
       {r(SCORE, 2)} AS avg_review
FROM clean WHERE review_score IS NOT NULL AND approval_delay_hours IS NOT NULL GROUP BY 1""",
    "q4_1": _seller(
        "avg_review_score ASC NULLS LAST, seller_id",
        f", {r('avg_delivery_days', 1)} AS avg_delivery_days",
    ),
    "q4_2": _seller("avg_review_score DESC NULLS LAST, seller_id"),
    "q4_3": f"""
SELECT {CAT} AS category, total_reviews, {AVG2} AS avg_review,
       {r('negative_review_pct', 1)} AS negative_pct, {r('late_delivery_pct', 1)} AS late_delivery_pct,
       {r('avg_freight_value', 2)} AS avg_freight
FROM review_analysis WHERE total_reviews >= 20 AND {KNOWN}
{_top(f'negative_review_pct DESC, {CAT}', 15)}""",
    "q4_4": f"""
SELECT customer_state AS state, total_orders,
       {r('avg_review_when_late * late_delivery_pct / 1e2 + avg_review_when_ontime * on_time_pct / 1e2', 2)}
         AS avg_review,
       {r('late_delivery_pct', 1)} AS late_pct, {r('avg_freight_value', 2)} AS avg_freight,
       {r('avg_delivery_days', 1)} AS avg_delivery
FROM delivery_performance WHERE total_orders >= 50""",
    "q4_5": f"""
SELECT payment_type, total_orders, {AVG2} AS avg_review, {r('avg_installments', 1)} AS avg_installments,
       {r('avg_payment_value', 2)} AS avg_value
FROM payment_analysis WHERE payment_type <> 'missing'""",
    "q4_6": f"""
SELECT product_id, {CAT} AS category, total_orders, {r('total_revenue', 2)} AS revenue,
       {AVG2} AS avg_review, total_unique_buyers
FROM products_performance WHERE total_orders >= 5 AND avg_review_score < 3.5 AND {KNOWN}
{_top('products_performance.total_revenue DESC, product_id', 20)}""",
    "q4_7": f"""
SELECT order_hour, total_orders, {r('total_revenue', 2)} AS revenue,
       {r('avg_items_per_order', 1)} AS avg_items,
       {r('capacity_utilization_pct', 1)} AS utilization_pct, peak_label
FROM hourly_capacity""",
    "q5_1": f"""
SELECT column_name, total_rows, missing_count, {r('missing_pct', 2)} AS missing_pct, ingested_date
FROM data_quality_report""",
    "q5_2": f"""
SELECT (SELECT max(batch_time) FROM history_category_trend) AS latest_batch,
       (SELECT count(DISTINCT {CAT}) FROM history_category_trend WHERE {KNOWN}) AS categories_tracked,
       (SELECT count(DISTINCT ingested_date) FROM history_category_trend) AS total_batch_days,
       (SELECT {N} FROM clean) AS total_orders_ingested,
       (SELECT count(DISTINCT customer_unique_id) FROM clean) AS total_customers_ingested,
       (SELECT max(ingested_date) FROM clean) AS last_ingest_date""",
    "q5_3": f"""
SELECT column_name, missing_count, total_rows, {r('missing_pct', 2)} AS pct,
       {_over('missing_pct', L.NULL_IMPACT)} AS impact_level
FROM data_quality_report""",
    "q6_1": f"""
SELECT loyalty_tier, count(*) AS total_customers, {MEAN_SPEND} AS avg_clv,
       {r('avg(total_orders)', 1)} AS avg_orders, {r('avg(avg_review_score)', 2)} AS avg_review,
       {r('avg(recency_days)', 0)} AS avg_recency
FROM customer_loyalty_rfm GROUP BY loyalty_tier""",
    "q6_2": f"""
SELECT comment_status, {N} AS total_orders, {r(SCORE, 2)} AS avg_review,
       {r(ratio(f'({hits(NEG)} * 1e2)', 'count(*)'), 1)} AS negative_pct
FROM (SELECT order_id, review_score,
             if(review_comment_message IS NULL OR review_comment_message IN ('', 'missing'),
                '{L.WITHOUT_COMMENT}', '{L.WITH_COMMENT}') AS comment_status
      FROM clean WHERE review_score IS NOT NULL)
GROUP BY comment_status""",
    "q6_3": f"""
SELECT {t.MONTH} AS month, {r(SCORE, 3)} AS avg_review, {N} AS total_orders, {PERCENTS}
FROM clean WHERE review_score IS NOT NULL AND order_purchase_timestamp IS NOT NULL
GROUP BY {t.MONTH} HAVING {N} >= 50""",
    "q6_4": " UNION ALL ".join(
        [
            _factor("Late Delivery", LATE, ON_TIME),
            _factor("High Freight (>30)", "freight_value > 30", "freight_value <= 30"),
            _factor("Slow Approval (>24h)", "approval_delay_hours > 24", "approval_delay_hours <= 24"),
            _factor("Heavy Product (>5kg)", "product_weight_g > 5000", "product_weight_g <= 5000"),
        ]
    ),
    "q6_5": f"""
SELECT keyword, review_bucket, {r('tfidf_score', 4)} AS tfidf_score, {r('log_odds', 3)} AS log_odds,
       freq_negative, freq_positive, total_docs
FROM tfidf_review_keywords WHERE review_bucket = 'negative'
{_top('tfidf_review_keywords.tfidf_score DESC, keyword', 20)}""",
    "q6_6": f"""
SELECT keyword, {r('log_odds', 3)} AS log_odds, freq_negative, freq_positive, total_docs
FROM tfidf_review_keywords
WHERE review_bucket = 'negative' AND freq_negative >= 10 AND total_docs >= 10
{_top('tfidf_review_keywords.log_odds DESC, keyword', 20)}""",
    "q7_1": f"""
SELECT year_month, {r('avg_review_score', 3)} AS avg_review, total_reviews, total_orders,
       {r('positive_review_pct', 1)} AS positive_pct, {r('negative_review_pct', 1)} AS negative_pct,
       {r('neutral_review_pct', 1)} AS neutral_pct
FROM monthly_review_trend WHERE total_orders >= 50""",
    "q7_2": f"""
SELECT year_month, {r('positive_review_pct', 1)} AS positive_pct,
       {r('neutral_review_pct', 1)} AS neutral_pct, {r('negative_review_pct', 1)} AS negative_pct
FROM monthly_review_trend WHERE total_orders >= 50""",
    "q7_3": f"""
SELECT year_month, {AVG2} AS avg_review, {r('late_delivery_pct', 1)} AS late_delivery_pct,
       {r('avg_delivery_delay_days', 1)} AS avg_delay_days, {r('avg_freight_value', 2)} AS avg_freight
FROM monthly_review_trend WHERE total_orders >= 50""",
    "q7_4": f"""
SELECT is_late AS late_delivery, is_high_freight AS high_freight, is_slow_approval AS slow_approval,
       total_orders, {AVG2} AS avg_review, {r('negative_review_pct', 1)} AS negative_pct,
       {r('positive_review_pct', 1)} AS positive_pct, factor_count AS num_factors
FROM review_root_cause_matrix""",
    "q7_5": f"""
SELECT CASE factor_count {' '.join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(L.FACTOR_GROUPS))} END
         AS factor_group, factor_count, CAST(sum(total_orders) AS BIGINT) AS total_orders_sum,
       {r(ratio('sum(avg_review_score * total_orders)', 'sum(total_orders)'), 2)} AS weighted_avg_review,
       {r(ratio('sum(negative_review_pct * total_orders)', 'sum(total_orders)'), 1)}
         AS weighted_negative_pct
FROM review_root_cause_matrix GROUP BY factor_count""",
    "q7_6": f"""
SELECT seller_state, customer_state, is_same_state, total_orders, {AVG2} AS avg_review,
       {r('avg_shipping_days', 1)} AS avg_shipping_days, {r('late_delivery_pct', 1)} AS late_pct
FROM seller_state_review WHERE total_orders >= 20
{_top('avg_review_score, seller_state, customer_state', 30)}""",
    "q7_7": f"""
SELECT year_month, review_score, total_count, month_total, {r('score_pct', 1)} AS score_pct
FROM review_score_shift WHERE month_total >= 50""",
    "q7_8": f"""
SELECT year_month, CAST({_counted('1, 5')} AS BIGINT) AS extreme_count,
       CAST(sum(total_count) AS BIGINT) AS total_count_sum,
       {_score_pct('1, 5')} AS polarization_index, {_score_pct('5')} AS five_star_pct,
       {_score_pct('1')} AS one_star_pct
FROM review_score_shift WHERE month_total >= 50 GROUP BY year_month""",
    "q8_1": f"""
SELECT scenario_id, scenario_name, {r('baseline_avg_review', 3)} AS baseline_review,
       {r('projected_avg_review', 3)} AS projected_review, {r('review_delta', 3)} AS review_delta,
       {r('review_improvement_pct', 1)} AS improvement_pct, affected_orders,
       {r('affected_pct', 1)} AS affected_pct, {r('ci_lower_95', 3)} AS ci_lower,
       {r('ci_upper_95', 3)} AS ci_upper, model_type
FROM simulation_scenarios""",
    "q8_2": f"""
SELECT scenario_id, scenario_name, total_orders, affected_orders,
       total_orders - affected_orders AS unaffected_orders, {r('affected_pct', 1)} AS affected_pct,
       {r('1e2 - affected_pct', 1)} AS unaffected_pct
FROM simulation_scenarios""",
    "q8_3": f"""
SELECT scenario_id, scenario_name, additional_orders_est,
       {r('revenue_impact_est_brl', 2)} AS revenue_impact_brl, {r('review_delta', 3)} AS review_delta,
       {r('affected_pct', 1)} AS affected_pct,
       {_over('revenue_impact_est_brl', L.ROI_LEVELS)} AS roi_level
FROM simulation_scenarios WHERE review_delta > 0""",
    "q8_4": f"""
SELECT scenario_id, scenario_name, {r('baseline_negative_pct', 1)} AS baseline_negative_pct,
       {r('projected_negative_pct', 1)} AS projected_negative_pct,
       {r('negative_delta', 1)} AS negative_reduction,
       {r('baseline_positive_pct', 1)} AS baseline_positive_pct,
       {r('projected_positive_pct', 1)} AS projected_positive_pct, {r('positive_delta', 1)} AS positive_gain
FROM simulation_scenarios""",
}


def dashboard_sql() -> dict[str, str]:
    return {name: t.statement(sql) for name, sql in QUERIES.items()}


def table_sql() -> dict[str, str]:
    return {f"agg_{name}": t.statement(f"SELECT * FROM {name}") for name in t.TABLES}


# ------------------------------------------------------------------ single operators

_SQUEEZED = r"[^a-záéíóúâêôãõç\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _list(words) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words) + "]"


def _cleaned(stop: list[str]) -> str:
    return f"""
  SELECT review_id, review_score,
         list_filter(regexp_split_to_array(
             regexp_replace(lower(review_comment_message), '{_SQUEEZED}', '', 'g'), '{_SPACES}'),
             lambda x: length(x) > 2 AND NOT list_contains({_list(stop)}, x)) AS cleaned
  FROM reviews_in WHERE review_comment_message IS NOT NULL"""



def _tie(column: str, digits: int) -> str:
    return f"{r(column, digits)} AS {column}"


def _bootstrap(replicates: int = 500, seed: int = 42, draws: int = 8) -> str:
    """The scenario summary with an interval of means drawn by MD5."""
    bounds = [int(65536 * sum(math.exp(-1) / math.factorial(i) for i in range(n + 1))) for n in range(8)]
    once = " + ".join(
        f"CASE WHEN n > {i} THEN {' + '.join(f'(u{i} >= {bound})::BIGINT' for bound in bounds)} ELSE 0 END"
        for i in range(draws)
    )
    spread = f"({' + '.join(f'u{i}' for i in range(draws))} - {draws * 65535 / 2}e0)"
    normal = f"floor(n + sqrt(CAST(n AS DOUBLE)) * ({spread} / {65536 * math.sqrt(draws / 12)!r}e0) + 0.5e0)"
    digits = ", ".join(
        f"CAST('0x' || substr(digest, {4 * i + 1}, 4) AS BIGINT) AS u{i}" for i in range(draws)
    )
    return f"""
SELECT s.* EXCLUDE (ci_lower_95, ci_upper_95), c.ci_lower_95, c.ci_upper_95
FROM simulation_scenarios s JOIN (
  SELECT scenario_id, {r('quantile_cont(mean, 0.025)', 4)} AS ci_lower_95, {r('quantile_cont(mean, 0.975)', 4)} AS ci_upper_95
  FROM (
    SELECT scenario_id, replicate, CAST(sum(times * score) AS DOUBLE) / (sum(times) * 1000e0) AS mean
    FROM (
      SELECT *, CASE WHEN n <= {draws} THEN {once} ELSE CAST(greatest({normal}, 0) AS BIGINT) END AS times
      FROM (
        SELECT *, {digits}
        FROM (
          SELECT *, md5('{seed}-' || scenario_id || '-' || score || '-' || replicate) AS digest
          FROM (SELECT scenario_id, CAST(round(predicted * 1000) AS BIGINT) AS score, count(*) AS n
                FROM rule_scored GROUP BY ALL),
               (SELECT unnest(generate_series(1, {replicates})) AS replicate))))
    GROUP BY ALL)
  GROUP BY ALL) c ON s.scenario_id = c.scenario_id"""


def operator_sql() -> dict[str, str]:
    from cartpulse.functions.text import DOMAIN_STOP_WORDS, EXTRA_STOP_WORDS
    from cartpulse.operators.keywords import COMPLAINT_CAUSES
    from cartpulse.operators.whatif import FEATURES
    from verification.stopwords import PORTUGUESE

    plain = PORTUGUESE + EXTRA_STOP_WORDS
    times = [f"order_{x}" for x in (
        "purchase_timestamp", "approved_at", "delivered_carrier_date", "delivered_customer_date",
        "estimated_delivery_date")]
    as_text = ", ".join(t.TEXT_TIME.format(name) for name in times)
    one_per_order = "(SELECT DISTINCT ON (order_id) * FROM clean)"
    labelled = t.term_ctes(t.LABELLED_CORPUS)
    causes = " UNION ALL ".join(
        f"""SELECT '{cause}' AS cause,
  coalesce(CAST(sum(w) FILTER (WHERE list_has_any(g, {_list(words)})) AS BIGINT), 0) AS review_items
  FROM grams"""
        for cause, words in COMPLAINT_CAUSES.items()
    )
    scenarios = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in t.NAMES.items())
    days = [f"{n}{c}_sim" for n in ("delivery_delay_days", "shipping_duration_days") for c in ("", "_clipped")]
    statements = {
        "input_payments_per_order": "SELECT * FROM payments_agg",
        "input_latest_reviews": "SELECT * FROM reviews_latest",
        "input_products_in_english": "SELECT * FROM products_in",
        "input_order_measures": f"""
SELECT * REPLACE ({as_text}),
       date_diff('second', order_estimated_delivery_date, order_delivered_customer_date) / 86400e0
         AS delivery_delay_days,
       date_diff('second', order_delivered_carrier_date, order_delivered_customer_date) / 86400e0
         AS shipping_duration_days,
       date_diff('second', order_purchase_timestamp, order_approved_at) / 3600e0 AS approval_delay_hours,
       CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END
         AS is_late_delivery,
       CAST(hour(order_purchase_timestamp) AS INTEGER) AS order_hour_of_day,
       CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS order_day_of_week
FROM orders_in""",
        "fact_before_imputation": f"SELECT * REPLACE ({as_text}) FROM fact",
        "fact_order_grain": """
SELECT order_id, count(*) AS n_items, CAST(sum(price_u) AS BIGINT) AS price_units,
       CAST(sum(freight_u) AS BIGINT) AS freight_units, any_value(customer_unique_id) AS customer_unique_id,
       any_value(customer_city) AS customer_city, any_value(customer_state) AS customer_state,
       any_value(customer_zip_code_prefix) AS customer_zip_code_prefix,
       any_value(payment_type) AS payment_type, any_value(payment_installments) AS payment_installments,
       any_value(payment_value) AS payment_value, any_value(review_score) AS review_score,
       any_value(is_late_delivery) AS is_late_delivery
FROM clean GROUP BY order_id""",
        "fact_latest_snapshot": f"SELECT * REPLACE ({as_text}) FROM fact",
        "state_totals": f"""
SELECT customer_state, {N} AS total_orders, {t.money('price')} AS total_revenue,
       {SCORE} AS avg_review_score, count(DISTINCT customer_unique_id) AS total_customers
FROM clean GROUP BY customer_state""",
        "loyalty_once_per_order": t.loyalty(
            f"""SELECT * REPLACE ((SELECT {t.money('payment')} FROM {one_per_order} o
                WHERE o.customer_unique_id = l.customer_unique_id) AS total_spend) FROM ({t.LOYALTY}) l"""
        ),
        "payments_once_per_order": f"""
SELECT p.* REPLACE (o.total AS total_revenue, o.average AS avg_payment_value)
FROM payment_analysis p JOIN (
  SELECT payment_type, {t.money('payment')} AS total, {t.mean_money('payment')} AS average
  FROM {one_per_order} GROUP BY payment_type) o USING (payment_type)""",
        "delivery_delivered_only": t.delivery("delivery_delay_days IS NOT NULL"),
        "text_keyword_tokens": f"""
SELECT order_id,
       array_to_string(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1])), ' ')
         AS tokens
FROM (SELECT order_id, list_filter({t.TOKENS.format(text='review_comment_message')}, lambda x: length(x) > 2) AS w
      FROM {one_per_order} WHERE review_score IS NOT NULL AND review_comment_message <> 'missing')""",
        "text_complaint_causes": causes,
        "text_notebook_words": f"""
SELECT word, count(*) AS frequency
FROM (SELECT unnest(cleaned) AS word FROM ({_cleaned(plain)}) WHERE review_score = 1)
GROUP BY word {_top('frequency DESC, word', 20)}""",
        "text_cleaned_reviews": f"""
SELECT review_id, review_score, array_to_string(cleaned, ' ') AS cleaned_text FROM ({_cleaned(plain)})""",
        "agg_top_bad_review_words": f"""
SELECT word, CAST(sum(w) AS BIGINT) AS frequency
FROM (SELECT w, unnest(regexp_split_to_array(lower(text), '[^a-záéíóúâêôãõç]+')) AS word
      FROM (SELECT review_comment_message AS text, count(*) AS w FROM clean
            WHERE review_score <= 2 AND review_comment_message <> 'missing' GROUP BY 1))
WHERE length(word) > 2 AND NOT list_contains({_list(plain + DOMAIN_STOP_WORDS)}, word)
GROUP BY word {_top('frequency DESC, word', 20)}""",
        "whatif_baseline": f"""
SELECT count(*) AS total_orders, {r(SCORE, 4)} AS avg_review_score,
       {', '.join(f"{r(ratio(hits(w), 'count(*)') + ' * 1e2', 4)} AS {n}" for n, w in (
           ('positive_pct', POS), ('negative_pct', NEG), ('neutral_pct', 'review_score = 3'),
           ('late_delivery_pct', 'is_late = 1'), ('high_freight_pct', 'is_high_freight = 1'),
           ('heavy_product_pct', 'is_heavy_product = 1')))},
       {r('avg(shipping_duration_days)', 4)} AS avg_shipping_days,
       {r('avg(freight_value)', 4)} AS avg_freight_value
FROM prepared""",
        "whatif_predictors": f"""
SELECT order_id, order_item_id, review_score, {', '.join(FEATURES)} FROM prepared""",
        "whatif_simulated_rows": f"""
SELECT order_id, order_item_id, scenario_id, {', '.join(_tie(d, 6) for d in days)},
       freight_value_sim, freight_value_clipped_sim, is_late_sim, is_high_freight_sim,
       is_likely_slow_approval_sim, {r('predicted', 3)} AS predicted
FROM rule_scored""",
        "whatif_rule_summary": "SELECT * FROM simulation_scenarios",
        "whatif_bootstrap_summary": _bootstrap(),
        "whatif_best_scenario": f"""
SELECT scenario_id, scenario_name, projected_avg_review, review_delta
FROM simulation_scenarios {_top('review_delta DESC, scenario_id', 1)}""",
        "whatif_rule_detail": f"""
SELECT order_id, order_item_id, review_score AS actual_review,
       {_tie('delivery_delay_days', 6)}, freight_value, is_late, is_high_freight, is_heavy_product,
       {', '.join(f'CAST(review_score AS DOUBLE) AS predicted_review_{s}' for s in t.NAMES)},
       0e0 AS "max_uplift_S5"
FROM prepared""",
        "source_csv_orders": f"SELECT * REPLACE ({as_text}) FROM orders_in",
        "source_csv_items": "SELECT * FROM items_in",
        "source_csv_reviews": f"""
SELECT review_id, order_id, review_score, {t.TEXT_TIME.format('review_creation_date')},
       md5(review_comment_message) AS text_md5, CAST(length(review_comment_message) AS INTEGER) AS text_length
FROM reviews_in""",
        "source_csv_scenarios": "SELECT * FROM simulation_scenarios",
        "source_utf16_sample": """
SELECT review_score, count(*) AS sampled,
       CAST(sum(CAST(round(delivery_delay_days * 86400) AS BIGINT)) AS BIGINT) AS delay_seconds,
       CAST(sum(CAST(round(shipping_duration_days * 86400) AS BIGINT)) AS BIGINT) AS duration_seconds,
       CAST(sum(freight_u) AS BIGINT) AS freight_units, CAST(sum(price_u) AS BIGINT) AS price_units,
       count(product_weight_g) AS weighed
FROM clean WHERE review_score IS NOT NULL GROUP BY review_score""",
        **{
            f"kept_{name}": f"SELECT * FROM {name}"
            for name in (
                "category_summary", "customer_loyalty_rfm", "geographic_analysis", "tfidf_review_keywords",
            )
        },
        "stream_category_trend": f"""
SELECT event_type AS category, count(DISTINCT event_id) AS total_orders,
       {r("CAST(sum(CAST(round(value * 10000) AS BIGINT)) AS DOUBLE) / 10000e0", 2)} AS total_revenue
FROM events GROUP BY event_type""",
    }
    found = {name: t.statement(sql) for name, sql in statements.items()}
    for name, select in {
        "text_term_counts": """
SELECT word, CAST(freq_negative AS BIGINT) AS freq_negative, CAST(freq_neutral AS BIGINT) AS freq_neutral,
       CAST(freq_positive AS BIGINT) AS freq_positive, CAST(doc_freq AS BIGINT) AS doc_freq
FROM tf JOIN df USING (word)""",
        "text_corpus_scores": "SELECT * FROM scored",
        "text_corpus_keywords": t.KEYWORDS,
    }.items():
        found[name] = t.statement(select, labelled)
    return found


def all_sql() -> dict[str, str]:
    return dashboard_sql() | table_sql() | operator_sql()
