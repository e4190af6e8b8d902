"""The generated star-schema tables, seen as the eight inputs.

Amounts that would need rounding are worked out in whole cents, so that any
engine gets the same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.operators.fact import Inputs, bytes_of, join_spread


# Stated, so that opening a table starts no schema job.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_extendedprice double, l_tax double",
    "documents": "doc_id bigint, text string",
    "labels": "doc_id bigint, quality int",
    "events": "event_id bigint, ts timestamp_ntz, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _orders(orders: DataFrame) -> DataFrame:
    bought = "o_orderkey % 24"
    approved = f"{bought} + o_orderkey * 13 % 60"
    carried = f"{approved} + (o_orderkey % 5 + 1) * 24"
    delivered = f"{carried} + o_orderkey * 17 % 30 * 24"

    def after(hours: str) -> str:
        return f"timestampadd(HOUR, cast({hours} as int), o_orderdate)"

    return orders.selectExpr(
        "cast(o_orderkey as string) as order_id",
        "cast(o_custkey as string) as customer_id",
        "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end"
        " as order_status",
        f"{after(bought)} as order_purchase_timestamp",
        f"{after(approved)} as order_approved_at",
        f"{after(carried)} as order_delivered_carrier_date",
        f"if(o_orderstatus = 'P' and o_orderkey % 2 = 0, null, {after(delivered)})"
        " as order_delivered_customer_date",
        f"{after(f'{bought} + 480')} as order_estimated_delivery_date",
    )


def _items(lineitem: DataFrame) -> DataFrame:
    cents, percent = (f"cast(rint({name} * 100) as bigint)" for name in ("l_extendedprice", "l_tax"))
    return lineitem.selectExpr(
        "cast(l_orderkey as string) as order_id",
        "cast(l_linenumber as int) as order_item_id",
        "cast(l_partkey as string) as product_id",
        "cast(l_suppkey as string) as seller_id",
        "l_extendedprice as price",
        f"({cents} * {percent} + 5000) div 10000 / 100D as freight_value",
    )


def _payments(orders: DataFrame) -> DataFrame:
    numbered = orders.selectExpr(
        "*", "explode(sequence(1, cast(o_orderkey % 3 + 1 as int))) as seq"
    )
    return numbered.selectExpr(
        "cast(o_orderkey as string) as order_id",
        "seq as payment_sequential",
        "case (o_orderkey + seq) % 4 when 0 then 'credit_card' when 1 then 'boleto'"
        " when 2 then 'voucher' else 'debit_card' end as payment_type",
        "cast(o_orderkey * seq % 12 + 1 as int) as payment_installments",
        "cast(rint(o_totalprice * 100) as bigint) div (o_orderkey % 3 + 1) / 100D as payment_value",
    )


def _review_keys(orders: DataFrame, documents: DataFrame) -> DataFrame:
    """The reviews with the id of a document in place of their text."""
    n_docs = documents.agg(F.count("*").alias("n")).scalar()
    numbered = orders.filter("o_orderkey % 10 <> 0").selectExpr(
        "*", "explode(sequence(1, if(o_orderkey % 7 = 0, 2, 1))) as seq"
    )
    return numbered.selectExpr(
        "concat_ws('-', o_orderkey, seq) as review_id",
        "cast(o_orderkey as string) as order_id",
        "cast((o_orderkey * 3 + seq * 2 + o_orderkey % 3) % 5 + 1 as int) as review_score",
        "timestampadd(DAY, seq + 30, o_orderdate) as review_creation_date",
        "o_orderkey",
    ).select(
        "review_id",
        "order_id",
        "review_score",
        "review_creation_date",
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % n_docs).alias("text_id"),
    )


def _review_texts(documents: DataFrame) -> DataFrame:
    # one text per id, so that Catalyst may drop the join where no text is read; spread first,
    # since grouping sorts texts, and a file of one row group is a single task
    spread = documents.select(F.col("doc_id").alias("text_id"), "text").repartition("text_id")
    return spread.groupBy("text_id").agg(F.first("text").alias("review_comment_message"))


def _reviews(orders: DataFrame, documents: DataFrame) -> DataFrame:
    return join_spread(_review_keys(orders, documents), _review_texts(documents), "review_id")


def read_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The eight inputs, each opened on first use, as plans without rows."""

    def opened(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    def with_nation(name: str, key: str) -> DataFrame:
        return opened(name).join(opened("nation"), F.col(key) == F.col("n_nationkey"), "left")

    return Inputs(
        # of the documents as they lie, since telling their ids apart takes a shuffle
        text_bytes=lambda: bytes_of(opened("documents"), "text"),
        orders=lambda: _orders(opened("orders")),
        order_items=lambda: _items(opened("lineitem")),
        products=lambda: opened("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            "p_type as product_category_name",
            "p_size * 200D as product_weight_g",
        ),
        customers=lambda: with_nation("customer", "c_nationkey").selectExpr(
            "cast(c_custkey as string) as customer_id",
            "cast(c_custkey as string) as customer_unique_id",
            "cast(c_custkey as int) as customer_zip_code_prefix",
            "c_mktsegment as customer_city",
            "n_name as customer_state",
        ),
        sellers=lambda: with_nation("supplier", "s_nationkey").selectExpr(
            "cast(s_suppkey as string) as seller_id",
            "cast(s_suppkey as int) as seller_zip_code_prefix",
            "s_name as seller_city",
            "n_name as seller_state",
        ),
        order_payments=lambda: _payments(opened("orders")),
        order_reviews=lambda: _reviews(opened("orders"), opened("documents")),
        review_keys=lambda: _review_keys(opened("orders"), opened("documents")),
        review_texts=lambda: _review_texts(opened("documents")),
        category_translation=lambda: opened("part")
        .filter(F.col("p_type") != "PROMO")
        .select(F.col("p_type").alias("product_category_name"))
        .distinct()
        .withColumn("product_category_name_english", F.lower("product_category_name")),
    )


def labelled_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a text corpus: their quality label is the bucket.

    The texts are spread by document first: a file of one row group is a single task, which
    would fold all of its texts in memory.
    """
    documents = table(spark, sf_dir, "documents").filter(F.length("text") > 5)
    documents = documents.repartition("doc_id")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        "text",
        F.when(F.col("quality") == 0, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral")
        .alias("review_bucket"),
        F.lit(1).cast("long").alias("weight"),
    )


def events_as_items(events: DataFrame) -> DataFrame:
    """Events as item rows of the trend: the event type is the category."""
    return events.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("event_type").alias("product_category_name_english"),
        F.col("value").alias("price"),
        F.lit(0.0).alias("freight_value"),
        F.lit(None).cast("int").alias("review_score"),
    )
