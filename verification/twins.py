"""DuckDB SQL that gives the same rows as the registered Spark queries.

Written against the plain test tables and straight from the definitions: one
item-grain fact, ``count(DISTINCT ...)`` and ``FILTER`` clauses, no roll-ups.
Sums run over whole units (1/10000 of the currency, seconds), so both sides
divide the same two numbers.
"""

from __future__ import annotations

RUN_DATE = "2024-01-31"


def r(expr: str, digits: int) -> str:
    """Half-up rounding of a double, as Spark rounds."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30,8)), {digits}) AS DOUBLE)"


def ratio(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0))"


def money(name: str) -> str:
    return f"(CAST(sum({name}_u) AS DOUBLE) / 10000e0)"


def mean_money(name: str) -> str:
    return ratio(f"sum({name}_u)", "(count(*) * 10000)")


def mean(name: str, where: str = "true") -> str:
    return ratio(
        f"sum({name}) FILTER (WHERE {where})", f"count({name}) FILTER (WHERE {where})"
    )


def mean_days(name: str) -> str:
    return ratio(f"sum({name}_s)", f"(count({name}_s) * 86400)")


def hits(where: str) -> str:
    return f"count(*) FILTER (WHERE {where})"


def share(where: str, digits: int = 2) -> str:
    return r(f"{ratio(hits(where), 'count(*)')} * 1e2", digits)


def percent(where: str, base: str) -> str:
    return r(ratio(f"({hits(where)} * 1e2)", hits(base)), 1)


ORDERS = "count(DISTINCT order_id)"
CAT = "product_category_name_english"
LATE, ON_TIME = "is_late_delivery = 1", "is_late_delivery = 0"
POS, NEG, NEU = "review_score >= 4", "review_score <= 2", "review_score = 3"
MONTH = "strftime(order_purchase_timestamp, '%Y-%m')"
SCORE = mean("review_score")

# ------------------------------------------------------------------ inputs and fact

INPUTS = """
orders_in AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
         o_orderdate + to_hours(o_orderkey % 24) AS order_purchase_timestamp,
         o_orderdate + to_hours(o_orderkey % 24 + o_orderkey * 13 % 60) AS order_approved_at,
         o_orderdate + to_hours(o_orderkey % 24 + o_orderkey * 13 % 60 + (1 + o_orderkey % 5) * 24)
           AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN NULL
              ELSE o_orderdate + to_hours(o_orderkey % 24 + o_orderkey * 13 % 60
                   + (1 + o_orderkey % 5) * 24 + (o_orderkey * 17 % 30) * 24) END
           AS order_delivered_customer_date,
         o_orderdate + to_hours(o_orderkey % 24 + 480) AS order_estimated_delivery_date
  FROM orders),
items_in AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS INTEGER) AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         l_extendedprice AS price,
         CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT) + 5000)
              // 10000 AS DOUBLE) / 100e0 AS freight_value
  FROM lineitem),
customers_in AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id,
         c_mktsegment AS customer_city, n_name AS customer_state,
         CAST(c_custkey AS INTEGER) AS customer_zip_code_prefix
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
sellers_in AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS seller_city, n_name AS seller_state,
         CAST(s_suppkey AS INTEGER) AS seller_zip_code_prefix
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
translation_in AS (
  SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'),
products_in AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
         product_category_name_english, p_size * 200e0 AS product_weight_g
  FROM part LEFT JOIN translation_in ON p_type = product_category_name),
payments_in AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, seq,
         CASE (o_orderkey + seq) % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto'
              WHEN 2 THEN 'voucher' ELSE 'debit_card' END AS payment_type,
         CAST(1 + (o_orderkey * seq) % 12 AS INTEGER) AS payment_installments,
         CAST(CAST(round(o_totalprice * 100) AS BIGINT) // (1 + o_orderkey % 3) AS DOUBLE) / 100e0
           AS payment_value
  FROM (SELECT *, unnest(range(1, o_orderkey % 3 + 2)) AS seq FROM orders)),
payments_agg AS (
  SELECT order_id, arg_min(payment_type, seq) AS payment_type,
         max(payment_installments) AS payment_installments,
         CAST(sum(CAST(round(payment_value * 10000) AS BIGINT)) AS DOUBLE) / 10000e0 AS payment_value
  FROM payments_in GROUP BY order_id),
reviews_in AS (
  SELECT CAST(o_orderkey AS VARCHAR) || '-' || CAST(seq AS VARCHAR) AS review_id,
         CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(1 + (3 * o_orderkey + 2 * seq + o_orderkey % 3) % 5 AS INTEGER) AS review_score,
         o_orderdate + to_days(CAST(30 + seq AS INTEGER)) AS review_creation_date,
         d.text AS review_comment_message
  FROM (SELECT *, unnest(range(1, CASE WHEN o_orderkey % 7 = 0 THEN 3 ELSE 2 END)) AS seq
        FROM orders WHERE o_orderkey % 10 <> 0) o
  LEFT JOIN documents d
    ON o.o_orderkey % 3 = 0 AND d.doc_id = o.o_orderkey % (SELECT count(*) FROM documents)),
reviews_latest AS (
  SELECT order_id, review_score, review_comment_message FROM reviews_in
  QUALIFY row_number() OVER (PARTITION BY order_id
          ORDER BY review_creation_date DESC NULLS FIRST, review_id DESC) = 1)
"""

FACT = f"""
fact AS (
  SELECT i.order_id, o.customer_id, c.customer_unique_id, i.order_item_id, i.product_id, i.seller_id,
         o.order_status, o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
         o.order_delivered_customer_date, o.order_estimated_delivery_date,
         c.customer_city, c.customer_state, c.customer_zip_code_prefix,
         s.seller_city, s.seller_state, s.seller_zip_code_prefix,
         p.product_category_name, p.product_category_name_english, p.product_weight_g,
         i.price, i.freight_value, i.price + i.freight_value AS total_item_value,
         pa.payment_type, pa.payment_installments, pa.payment_value,
         rv.review_score, rv.review_comment_message,
         date_diff('second', o.order_estimated_delivery_date, o.order_delivered_customer_date) / 86400e0
           AS delivery_delay_days,
         date_diff('second', o.order_delivered_carrier_date, o.order_delivered_customer_date) / 86400e0
           AS shipping_duration_days,
         date_diff('second', o.order_purchase_timestamp, o.order_approved_at) / 3600e0
           AS approval_delay_hours,
         CASE WHEN o.order_delivered_customer_date > o.order_estimated_delivery_date THEN 1 ELSE 0 END
           AS is_late_delivery,
         CAST(hour(o.order_purchase_timestamp) AS INTEGER) AS order_hour_of_day,
         CAST(isodow(o.order_purchase_timestamp) - 1 AS INTEGER) AS order_day_of_week,
         '{RUN_DATE}' AS ingested_date
  FROM items_in i
  LEFT JOIN orders_in o ON i.order_id = o.order_id
  LEFT JOIN customers_in c ON o.customer_id = c.customer_id
  LEFT JOIN products_in p ON i.product_id = p.product_id
  LEFT JOIN sellers_in s ON i.seller_id = s.seller_id
  LEFT JOIN payments_agg pa ON i.order_id = pa.order_id
  LEFT JOIN reviews_latest rv ON i.order_id = rv.order_id),
clean AS (
  SELECT * REPLACE (
           coalesce(customer_id, 'missing') AS customer_id,
           coalesce(customer_unique_id, 'missing') AS customer_unique_id,
           coalesce(order_status, 'missing') AS order_status,
           coalesce(customer_city, 'missing') AS customer_city,
           coalesce(customer_state, 'missing') AS customer_state,
           coalesce(customer_zip_code_prefix, 0) AS customer_zip_code_prefix,
           coalesce(seller_city, 'missing') AS seller_city,
           coalesce(seller_state, 'missing') AS seller_state,
           coalesce(seller_zip_code_prefix, 0) AS seller_zip_code_prefix,
           coalesce(product_category_name, 'missing') AS product_category_name,
           coalesce({CAT}, 'missing') AS {CAT},
           coalesce(product_weight_g, 0) AS product_weight_g,
           coalesce(payment_type, 'missing') AS payment_type,
           coalesce(payment_installments, 0) AS payment_installments,
           coalesce(payment_value, 0) AS payment_value,
           coalesce(review_comment_message, 'missing') AS review_comment_message,
           coalesce(order_hour_of_day, 0) AS order_hour_of_day,
           coalesce(order_day_of_week, 0) AS order_day_of_week),
         CAST(round(price * 10000) AS BIGINT) AS price_u,
         CAST(round(freight_value * 10000) AS BIGINT) AS freight_u,
         CAST(round(coalesce(payment_value, 0) * 10000) AS BIGINT) AS payment_u,
         CAST(round(delivery_delay_days * 86400) AS BIGINT) AS delay_s,
         CAST(round(shipping_duration_days * 86400) AS BIGINT) AS shipping_s
  FROM fact)
"""

TEXT_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"

# ------------------------------------------------------------------ warehouse tables

LOYALTY = f"""
  SELECT customer_unique_id, {ORDERS} AS total_orders, {money('payment')} AS total_spend,
         {SCORE} AS avg_review_score,
         min(order_purchase_timestamp) AS first_order_date,
         max(order_purchase_timestamp) AS last_order_date
  FROM clean GROUP BY customer_unique_id"""

LOYALTY_DERIVED = """
  SELECT *, CAST(date_diff('day', CAST(last_order_date AS DATE),
                (SELECT max(CAST(order_purchase_timestamp AS DATE)) FROM clean)) AS INTEGER) AS recency_days,
         total_orders AS frequency, total_spend AS monetary,
         CASE WHEN total_orders >= 3 THEN 'Gold' WHEN total_orders >= 2 THEN 'Silver' ELSE 'Bronze' END
           AS loyalty_tier
  FROM ({base})"""


def loyalty(base: str = LOYALTY) -> str:
    return f"""
  SELECT * REPLACE ({TEXT_TIME.format('first_order_date')}, {TEXT_TIME.format('last_order_date')}),
         CASE WHEN recency_days > 60 THEN 'High' WHEN recency_days > 30 THEN 'Medium' ELSE 'Low' END
           AS churn_risk
  FROM ({LOYALTY_DERIVED.format(base=base)})"""


def delivery(where: str = "true") -> str:
    return f"""
  SELECT customer_state, {ORDERS} AS total_orders, {mean_days('shipping')} AS avg_delivery_days,
         {mean_days('delay')} AS avg_delay_days, {share(ON_TIME)} AS on_time_pct,
         {share(LATE)} AS late_delivery_pct, {mean('review_score', LATE)} AS avg_review_when_late,
         {mean('review_score', ON_TIME)} AS avg_review_when_ontime,
         {mean_money('freight')} AS avg_freight_value
  FROM clean WHERE {where} GROUP BY customer_state"""


AUDITED = (
    "order_id customer_id product_id seller_id product_category_name_english customer_state"
    " seller_state review_score price order_status"
).split()

TOKENS = "regexp_split_to_array(lower({text}), '[^a-zà-ü]+')"
CORPUS = """
  SELECT order_id, order_item_id, review_comment_message AS text, 1 AS weight,
         CASE WHEN review_score <= 2 THEN 'negative' WHEN review_score >= 4 THEN 'positive'
              ELSE 'neutral' END AS review_bucket
  FROM clean
  WHERE review_score IS NOT NULL AND review_comment_message <> 'missing'
    AND length(review_comment_message) > 5"""
LABELLED_CORPUS = """
  SELECT doc_id, text, 1 AS weight,
         CASE quality WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE 'neutral' END AS review_bucket
  FROM documents LEFT JOIN labels USING (doc_id) WHERE length(text) > 5"""


def term_ctes(corpus: str) -> dict[str, str]:
    """Word statistics; equal texts of a bucket are tokenised once and weighted."""
    return {
        "texts": f"SELECT text, review_bucket, sum(weight) AS w FROM ({corpus}) GROUP BY ALL",
        "words": f"""
  SELECT review_bucket, w, list_filter({TOKENS.format(text='text')}, lambda x: length(x) > 2) AS t FROM texts""",
        "grams": """
  SELECT review_bucket, w,
         list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || '_' || t[i + 1])) AS g
  FROM words WHERE len(t) > 0""",
        "tf": """
  SELECT word,
         coalesce(sum(w) FILTER (WHERE review_bucket = 'negative'), 0) AS freq_negative,
         coalesce(sum(w) FILTER (WHERE review_bucket = 'neutral'), 0) AS freq_neutral,
         coalesce(sum(w) FILTER (WHERE review_bucket = 'positive'), 0) AS freq_positive
  FROM (SELECT review_bucket, w, unnest(g) AS word FROM grams) GROUP BY word""",
        "df": """
  SELECT word, sum(w) AS doc_freq FROM (SELECT w, unnest(list_distinct(g)) AS word FROM grams)
  GROUP BY word""",
        "scored": f"""
  SELECT b.review_bucket, word AS keyword,
         {r("(ln(b.n) + 1) * ln((SELECT sum(w) FROM grams)::DOUBLE / doc_freq)", 4)} AS tfidf_score,
         {r('''CASE WHEN freq_negative + freq_positive > 0 THEN
              ln((freq_negative + 5e-1) / ((SELECT sum(freq_negative) FROM tf)::DOUBLE - freq_negative + 5e-1))
            - ln((freq_positive + 5e-1) / ((SELECT sum(freq_positive) FROM tf)::DOUBLE - freq_positive + 5e-1))
              ELSE 0e0 END''', 4)} AS log_odds,
         CAST(freq_negative AS BIGINT) AS freq_negative, CAST(freq_positive AS BIGINT) AS freq_positive,
         CAST(doc_freq AS BIGINT) AS total_docs
  FROM (SELECT *, unnest([{{'review_bucket': 'negative', 'n': freq_negative}},
                          {{'review_bucket': 'neutral', 'n': freq_neutral}},
                          {{'review_bucket': 'positive', 'n': freq_positive}}]) AS b
        FROM tf JOIN df USING (word))
  WHERE b.n > 0 AND doc_freq >= 10
    AND ln((SELECT sum(w) FROM grams)::DOUBLE / doc_freq) >= 2.8""",
    }


KEYWORDS = """
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY review_bucket ORDER BY tfidf_score DESC, keyword) <= 30"""

TABLES: dict[str, str] = {
    "order_items": "SELECT * EXCLUDE (price_u, freight_u, payment_u, delay_s, shipping_s) REPLACE ("
    + ", ".join(
        TEXT_TIME.format(f"order_{x}")
        for x in (
            "purchase_timestamp",
            "approved_at",
            "delivered_carrier_date",
            "delivered_customer_date",
            "estimated_delivery_date",
        )
    )
    + ") FROM clean",
    "data_quality_report": " UNION ALL ".join(
        f"""
  SELECT '{RUN_DATE}' AS ingested_date, '{c}' AS column_name, count(*) AS total_rows,
         {hits(f"{c} IS NULL OR CAST({c} AS VARCHAR) = 'missing'")} AS missing_count,
         {share(f"{c} IS NULL OR CAST({c} AS VARCHAR) = 'missing'")} AS missing_pct FROM fact"""
        for c in AUDITED
    ),
    "category_summary": f"""
  SELECT {CAT}, {ORDERS} AS total_orders, {money('price')} AS total_revenue, count(*) AS total_items,
         {SCORE} AS avg_review_score, {mean_money('price')} AS avg_price,
         {mean_money('freight')} AS avg_freight
  FROM clean GROUP BY {CAT}""",
    "top_products": f"""
  SELECT {CAT}, {ORDERS} AS total_orders, {money('price')} AS total_revenue,
         {mean_money('price')} AS avg_price, {SCORE} AS avg_review_score, count(*) AS total_items
  FROM clean GROUP BY {CAT}""",
    "hourly_activity": f"""
  SELECT order_hour_of_day AS order_hour, {ORDERS} AS total_orders, count(*) AS total_items,
         {money('price')} AS total_revenue
  FROM clean GROUP BY order_hour_of_day""",
    "review_analysis": f"""
  SELECT {CAT}, count(*) AS total_reviews, {SCORE} AS avg_review_score,
         {share(POS)} AS positive_review_pct, {share(NEG)} AS negative_review_pct,
         {share(NEU)} AS neutral_review_pct, {mean_days('delay')} AS avg_delivery_delay_days,
         {share(LATE)} AS late_delivery_pct, {mean_money('freight')} AS avg_freight_value,
         {mean_money('price')} AS avg_price
  FROM clean WHERE review_score IS NOT NULL GROUP BY {CAT}""",
    "delivery_performance": delivery(),
    "seller_performance": f"""
  SELECT seller_id, seller_city, seller_state, {ORDERS} AS total_orders,
         {money('price')} AS total_revenue, {SCORE} AS avg_review_score,
         {mean_days('shipping')} AS avg_delivery_days, {share(LATE)} AS late_delivery_pct,
         count(*) AS total_products_sold
  FROM clean GROUP BY seller_id, seller_city, seller_state""",
    "customer_loyalty_rfm": loyalty(),
    "geographic_analysis": f"""
  SELECT customer_state, customer_city, {ORDERS} AS total_orders, {money('price')} AS total_revenue,
         {SCORE} AS avg_review_score, {mean_days('shipping')} AS avg_delivery_days,
         {mean_money('freight')} AS avg_freight_value,
         count(DISTINCT customer_unique_id) AS total_customers, {share(LATE)} AS late_delivery_pct
  FROM clean GROUP BY customer_state, customer_city""",
    "payment_analysis": f"""
  SELECT payment_type, {ORDERS} AS total_orders, {money('payment')} AS total_revenue,
         {mean_money('payment')} AS avg_payment_value,
         {mean('payment_installments')} AS avg_installments, {SCORE} AS avg_review_score
  FROM clean GROUP BY payment_type""",
    "sales_forecasting": f"""
  SELECT {CAT}, current_total_orders, current_total_revenue, avg_order_value, growth_rate,
         {r('current_total_orders * (growth_rate + 1)', 2)} AS forecasted_orders,
         {r('current_total_revenue * (growth_rate + 1)', 2)} AS forecasted_revenue,
         CASE WHEN growth_rate < 0 THEN 'High Risk' WHEN growth_rate <= 3e-1 THEN 'Medium'
              ELSE 'Low Risk' END AS risk_level
  FROM (SELECT {CAT}, {ORDERS} AS current_total_orders, {money('price')} AS current_total_revenue,
               {mean_money('price')} AS avg_order_value FROM clean GROUP BY {CAT})
  LEFT JOIN (SELECT {CAT}, {r(ratio('count(*) FILTER (WHERE n > 1)', 'count(*)'), 4)} AS growth_rate
             FROM (SELECT {CAT}, customer_unique_id, {ORDERS} AS n FROM clean
                   GROUP BY {CAT}, customer_unique_id) GROUP BY {CAT}) USING ({CAT})""",
    "history_category_trend": f"""
  SELECT {CAT}, {ORDERS} AS total_orders, {money('price')} AS total_revenue,
         {SCORE} AS avg_review_score, TIMESTAMP '{RUN_DATE} 00:00:00' AS batch_time,
         '{RUN_DATE}' AS ingested_date
  FROM clean GROUP BY {CAT}""",
    "daily_summary": f"""
  SELECT '{RUN_DATE}' AS summary_date, {ORDERS} AS total_orders, {money('price')} AS total_revenue,
         {ratio('count(*)', ORDERS)} AS avg_basket_size, {SCORE} AS avg_review_score,
         count(DISTINCT customer_unique_id) AS total_customers,
         {share(ON_TIME)} AS on_time_delivery_pct, {hits(LATE)} AS late_delivery_count,
         {mean_days('delay')} AS avg_delivery_delay_days, '{RUN_DATE}' AS ingested_date
  FROM clean""",
    "products_performance": f"""
  SELECT product_id, {CAT}, {ORDERS} AS total_orders, {money('price')} AS total_revenue,
         {mean_money('price')} AS avg_price, {mean_money('freight')} AS avg_freight,
         {SCORE} AS avg_review_score, count(DISTINCT customer_unique_id) AS total_unique_buyers
  FROM clean GROUP BY product_id, {CAT}""",
    "hourly_capacity": f"""
  SELECT *, CASE WHEN capacity_utilization_pct > 80 THEN 'Peak'
                 WHEN capacity_utilization_pct >= 50 THEN 'Normal' ELSE 'Off-Peak' END AS peak_label
  FROM (SELECT *, {r(ratio('total_orders', 'max(total_orders) OVER ()') + ' * 1e2', 2)}
                  AS capacity_utilization_pct
        FROM (SELECT order_hour_of_day AS order_hour, {ORDERS} AS total_orders,
                     {money('price')} AS total_revenue,
                     {ratio('count(*)', ORDERS)} AS avg_items_per_order
              FROM clean GROUP BY order_hour_of_day))""",
    "monthly_review_trend": f"""
  SELECT {MONTH} AS year_month, count(*) AS total_reviews, {SCORE} AS avg_review_score,
         {share(POS)} AS positive_review_pct, {share(NEU)} AS neutral_review_pct,
         {share(NEG)} AS negative_review_pct, {share(LATE)} AS late_delivery_pct,
         {mean_days('delay')} AS avg_delivery_delay_days, {mean_money('freight')} AS avg_freight_value,
         {ORDERS} AS total_orders
  FROM clean WHERE review_score IS NOT NULL AND order_purchase_timestamp IS NOT NULL
  GROUP BY {MONTH}""",
    "review_root_cause_matrix": f"""
  SELECT is_late, is_high_freight, is_slow_approval, {ORDERS} AS total_orders,
         {SCORE} AS avg_review_score, {share(NEG)} AS negative_review_pct,
         {share(POS)} AS positive_review_pct, any_value(n_factors) AS factor_count
  FROM (SELECT *, if(is_late_delivery = 1, 'Yes', 'No') AS is_late,
               if(freight_value > 30, 'Yes', 'No') AS is_high_freight,
               if(approval_delay_hours > 24, 'Yes', 'No') AS is_slow_approval,
               if(is_late_delivery = 1, 1, 0) + if(freight_value > 30, 1, 0)
                 + if(approval_delay_hours > 24, 1, 0) AS n_factors
        FROM clean WHERE review_score IS NOT NULL)
  GROUP BY is_late, is_high_freight, is_slow_approval""",
    "seller_state_review": f"""
  SELECT seller_state, customer_state, {ORDERS} AS total_orders, {SCORE} AS avg_review_score,
         {mean_days('shipping')} AS avg_shipping_days, {share(LATE)} AS late_delivery_pct,
         if(seller_state = customer_state, 'Same State', 'Different State') AS is_same_state
  FROM clean WHERE seller_state <> 'missing' AND customer_state <> 'missing'
    AND review_score IS NOT NULL
  GROUP BY seller_state, customer_state""",
    "monthly_delivery_accuracy": f"""
  SELECT *, avg_review_when_ontime - avg_review_when_late AS review_gap
  FROM (SELECT {MONTH} AS year_month, count(*) AS total_delivered, {share(ON_TIME)} AS on_time_pct,
               {share(LATE)} AS late_pct, {mean_days('delay')} AS avg_delay_days,
               {mean_days('shipping')} AS avg_shipping_days,
               {mean('review_score', LATE)} AS avg_review_when_late,
               {mean('review_score', ON_TIME)} AS avg_review_when_ontime
        FROM clean WHERE order_purchase_timestamp IS NOT NULL GROUP BY {MONTH})""",
    "review_score_shift": f"""
  SELECT year_month, review_score, total_count, CAST(month_total AS BIGINT) AS month_total,
         {r(ratio('total_count', 'month_total') + ' * 1e2', 2)} AS score_pct
  FROM (SELECT *, sum(total_count) OVER (PARTITION BY year_month) AS month_total
        FROM (SELECT {MONTH} AS year_month, review_score, count(*) AS total_count
              FROM clean WHERE review_score IS NOT NULL AND order_purchase_timestamp IS NOT NULL
              GROUP BY {MONTH}, review_score))""",
    "tfidf_review_keywords": KEYWORDS,
}

# ------------------------------------------------------------------ what-if


def _uplift(late: str, cheaper: str) -> str:
    base = f"CASE WHEN {late} THEN least(review_score + 1.708e0, 5e0) ELSE review_score::DOUBLE END"
    return f"CASE WHEN {cheaper} THEN least({base} + 1e-1, 5e0) ELSE {base} END"


PREPARED = """
  SELECT order_id, order_item_id, review_score, delivery_delay_days, shipping_duration_days,
         freight_value, price, product_weight_g, delay_s, price_u,
         CASE WHEN delivery_delay_days > 0 THEN 1 ELSE 0 END AS is_late,
         CASE WHEN freight_value > 30 THEN 1 ELSE 0 END AS is_high_freight,
         CASE WHEN product_weight_g > 5000 THEN 1 ELSE 0 END AS is_heavy_product,
         CASE WHEN delivery_delay_days > 14 THEN 1 ELSE 0 END AS is_likely_slow_approval,
         CASE WHEN delivery_delay_days IS NULL THEN NULL
              ELSE greatest(-30e0, least(60e0, delivery_delay_days)) END AS delivery_delay_days_clipped,
         CASE WHEN shipping_duration_days IS NULL THEN NULL
              ELSE greatest(0e0, least(60e0, shipping_duration_days)) END AS shipping_duration_days_clipped,
         greatest(0e0, least(150e0, freight_value)) AS freight_value_clipped,
         greatest(0e0, least(20000e0, product_weight_g)) AS product_weight_g_clipped,
         greatest(0e0, least(1000e0, price)) AS price_clipped
  FROM clean WHERE review_score IS NOT NULL"""

_MEAN_LATE = (
    "(SELECT CAST(sum(delay_s) AS DOUBLE) / (count(*) * 86400) FROM prepared"
    " WHERE delivery_delay_days > 0)"
)


def _after(scenario: str) -> str:
    """Changed columns of one scenario. The combined one equals S1 with S3:
    once nothing is late, the other two have nothing to change."""
    d, dc = "delivery_delay_days", "delivery_delay_days_clipped"
    s, sc = "shipping_duration_days", "shipping_duration_days_clipped"
    f, fc, hf = "freight_value", "freight_value_clipped", "is_high_freight"
    if scenario in ("S1", "S5"):
        s, sc = (
            f"CASE WHEN {d} > 0 THEN CASE WHEN {x} IS NULL THEN NULL"
            f" ELSE greatest(1e0, {x} - {_MEAN_LATE}) END ELSE {x} END"
            for x in (s, sc)
        )
        d, dc = f"CASE WHEN {d} > 0 THEN 0e0 ELSE {d} END", f"CASE WHEN {d} > 0 THEN 0e0 ELSE {dc} END"
    if scenario == "S2":
        s, sc = (
            f"CASE WHEN {d} > 14 THEN CASE WHEN {x} IS NULL THEN NULL"
            f" ELSE greatest(1e0, {x} - 1.5e0) END ELSE {x} END"
            for x in (s, sc)
        )
        dc = f"CASE WHEN {d} > 14 THEN greatest(-30e0, {dc} - 1.5e0) ELSE {dc} END"
        d = f"CASE WHEN {d} > 14 THEN greatest(-146e0, {d} - 1.5e0) ELSE {d} END"
    if scenario in ("S3", "S5"):
        f, fc, hf = f"least(30e0, {f})", f"least(30e0, {fc})", "0"
    if scenario == "S4":
        bad = "is_late = 1 AND (is_high_freight = 1 OR is_heavy_product = 1)"
        s = (
            f"CASE WHEN {bad} THEN CASE WHEN {s} IS NULL THEN NULL"
            f" ELSE greatest(1e0, {s} - 2e0) END ELSE {s} END"
        )
        dc = f"CASE WHEN {bad} THEN greatest(-30e0, {dc} - 2e0) ELSE {dc} END"
        d = f"CASE WHEN {bad} THEN greatest(-146e0, {d} - 2e0) ELSE {d} END"
    return f"""
  SELECT *, '{scenario}' AS scenario_id, {d} AS delivery_delay_days_sim,
         {dc} AS delivery_delay_days_clipped_sim, {s} AS shipping_duration_days_sim,
         {sc} AS shipping_duration_days_clipped_sim, {f} AS freight_value_sim,
         {fc} AS freight_value_clipped_sim, {hf} AS is_high_freight_sim FROM prepared"""


SIMULATED = f"""
  SELECT *, CASE WHEN delivery_delay_days_sim > 0 THEN 1 ELSE 0 END AS is_late_sim,
         CASE WHEN delivery_delay_days_sim > 14 THEN 1 ELSE 0 END AS is_likely_slow_approval_sim
  FROM ({' UNION ALL '.join(_after(f'S{i}') for i in range(1, 6))})"""

RULE_SCORED = f"""
  SELECT *, {_uplift('is_late = 1 AND is_late_sim = 0', 'freight_value_sim < freight_value')} AS predicted
  FROM simulated"""

SCENARIO_ROWS = f"""
  SELECT *, score_sum / n AS base, predicted_sum / (n * 1e6) AS projected, price_sum / (n * 1e4) AS price,
         was_positive / n * 1e2 AS wp, was_negative / n * 1e2 AS wn, was_neutral / n * 1e2 AS wu,
         is_positive / n * 1e2 AS ip, is_negative / n * 1e2 AS "in", is_neutral / n * 1e2 AS iu
  FROM (SELECT scenario_id, CAST(count(*) AS DOUBLE) AS n,
               {hits('''is_late IS DISTINCT FROM is_late_sim OR freight_value IS DISTINCT FROM freight_value_sim
                     OR delivery_delay_days IS DISTINCT FROM delivery_delay_days_sim''')} AS affected,
               CAST(sum(review_score) AS DOUBLE) AS score_sum,
               {hits(POS)} AS was_positive, {hits(NEG)} AS was_negative, {hits(NEU)} AS was_neutral,
               CAST(sum(CAST(round(predicted * 1e6) AS BIGINT)) AS DOUBLE) AS predicted_sum,
               {hits('predicted >= 4')} AS is_positive, {hits('predicted <= 2')} AS is_negative,
               {hits('predicted > 2 AND predicted < 4')} AS is_neutral,
               var_pop(predicted) AS variance, CAST(sum(price_u) AS DOUBLE) AS price_sum
        FROM rule_scored GROUP BY scenario_id)"""

NAMES = {
    "S1": "Eliminate Late Delivery",
    "S2": "Accelerate Order Approval (<6h)",
    "S3": "Cap Freight Cost (≤30 BRL)",
    "S4": "Remove Underperforming Sellers",
    "S5": "Best Case — All Solutions Combined",
}

TABLES["simulation_scenarios"] = f"""
  SELECT scenario_id,
         CASE scenario_id {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items())} END
           AS scenario_name,
         CAST(n AS BIGINT) AS total_orders, affected AS affected_orders,
         {r('affected / n * 1e2', 2)} AS affected_pct, {r('base', 4)} AS baseline_avg_review,
         {r('wp', 2)} AS baseline_positive_pct, {r('wn', 2)} AS baseline_negative_pct,
         {r('wu', 2)} AS baseline_neutral_pct, {r('projected', 4)} AS projected_avg_review,
         {r('ip', 2)} AS projected_positive_pct, {r('"in"', 2)} AS projected_negative_pct,
         {r('iu', 2)} AS projected_neutral_pct, {r('projected - base', 4)} AS review_delta,
         {r('ip - wp', 2)} AS positive_delta, {r('"in" - wn', 2)} AS negative_delta,
         {r('(projected - base) / base * 1e2', 2)} AS review_improvement_pct,
         {r('projected - 1.96e0 * sqrt(variance) / sqrt(n)', 4)} AS ci_lower_95,
         {r('projected + 1.96e0 * sqrt(variance) / sqrt(n)', 4)} AS ci_upper_95,
         CAST(floor(n * greatest(projected - base, 0e0) * 5e-2) AS BIGINT) AS additional_orders_est,
         {r('floor(n * greatest(projected - base, 0e0) * 5e-2) * price', 2)} AS revenue_impact_est_brl,
         'RuleBased' AS model_type
  FROM scenario_rows"""

# Helper CTEs between the fact and the tables, in order of use.
STEPS: dict[str, str] = {
    **term_ctes(CORPUS),
    "prepared": PREPARED,
    "simulated": SIMULATED,
    "rule_scored": RULE_SCORED,
    "scenario_rows": SCENARIO_ROWS,
}


def _mentions(sql: str, name: str) -> bool:
    import re

    return re.search(rf"\b{name}\b", sql) is not None


def statement(select: str, steps: dict[str, str] | None = None) -> str:
    """A full statement: inputs, fact, and the CTEs the query leads to."""
    known = {**(STEPS if steps is None else steps), **TABLES}
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name, body in known.items():
            if name not in needed and body is not sql and _mentions(sql, name):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(select)
    ctes = [INPUTS.strip(), FACT.strip(), *[f"{name} AS ({known[name]})" for name in needed]]
    return "WITH " + ",\n".join(ctes) + "\n" + select.strip()
