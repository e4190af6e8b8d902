"""Missing-value audit and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.functions import measures as M
from cartpulse.functions.labels import MISSING
from cartpulse.functions.times import as_text

# Which columns are filled with what. Review score, delivery delay,
# shipping duration and approval delay keep their NULLs, and so do timestamps.
TEXT_COLUMNS = (
    "order_id", "customer_id", "customer_unique_id", "product_id", "seller_id",
    "order_status", "customer_city", "customer_state", "seller_city", "seller_state",
    "product_category_name", "product_category_name_english", "payment_type",
    "review_comment_message", "ingested_date",
)
WHOLE_COLUMNS = (
    "order_item_id", "customer_zip_code_prefix", "seller_zip_code_prefix",
    "payment_installments", "is_late_delivery", "order_hour_of_day", "order_day_of_week",
)
REAL_COLUMNS = (
    "product_weight_g", "price", "freight_value", "total_item_value", "payment_value",
)
NULLABLE_TYPES = {
    "review_score": "int",
    "delivery_delay_days": "double",
    "shipping_duration_days": "double",
    "approval_delay_hours": "double",
}

# The columns the audit looks at.
AUDITED_COLUMNS = (
    "order_id", "customer_id", "product_id", "seller_id", "product_category_name_english",
    "customer_state", "seller_state", "review_score", "price", "order_status",
)


def _filled(name: str) -> str:
    if name in TEXT_COLUMNS:
        return f"coalesce({name}, '{MISSING}') as {name}"
    if name in WHOLE_COLUMNS:
        return f"cast(coalesce({name}, 0) as int) as {name}"
    if name in REAL_COLUMNS:
        return f"cast(coalesce({name}, 0D) as double) as {name}"
    if name in NULLABLE_TYPES:
        return f"cast({name} as {NULLABLE_TYPES[name]}) as {name}"
    return f"`{name}`"


def impute(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Fill the columns that are present, in one projection."""
    return df.selectExpr(*[f"`{name}`" if name in skip else _filled(name) for name in df.columns])


def timestamps_to_text(df: DataFrame) -> DataFrame:
    """The stored form of the fact: timestamps as ``yyyy-MM-dd HH:mm:ss`` text."""
    return df.select(
        *[
            as_text(F.col(name)).alias(name) if kind.startswith("timestamp") else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def audit(
    raw: DataFrame, columns: Sequence[str] = AUDITED_COLUMNS, ingested_date: str | None = None
) -> DataFrame:
    """NULL and sentinel counts of every column, from one pass over the rows."""
    absent = {
        name: M.hits(F.col(name).isNull() | (F.col(name).cast("string") == MISSING), name)
        for name in columns
    }
    rows = raw.withColumn("n_items", F.lit(1).cast("long"))
    counts = M.roll_up(rows, [], {"total_rows": M.items(), **absent})
    day = F.current_date() if ingested_date is None else F.lit(ingested_date)
    return counts.unpivot("total_rows", list(columns), "column_name", "missing_count").select(
        day.cast("string").alias("ingested_date"),
        "column_name",
        "total_rows",
        "missing_count",
        F.round(
            F.col("missing_count") / F.greatest("total_rows", F.lit(1)) * F.lit(100.0), 2
        ).alias("missing_pct"),
    )
