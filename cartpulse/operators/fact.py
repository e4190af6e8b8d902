"""Joining the eight inputs: item rows, order rows, and order lines in between.

All builders take the columns the caller needs and leave out every join that
contributes none of them: all joins are left joins to a unique key, so a join
nobody reads cannot change the result. Catalyst knows no primary keys and
cannot do that by itself.

Three grains, each with ``n_items``, ``price_units`` and ``freight_units``:

* ``clean_orders`` has one row per order;
* ``clean_lines`` has one row per order and item-level key (category, seller ...);
* ``clean_items`` has one row per item.

The first two sum the items *before* joining what hangs on the order, with a
map-side combine. An order, however many items it has, reaches the join as one
row per key, the joins on ``order_id`` share one partitioning, and orders are
counted with a plain count. No side is forced to broadcast: Spark does so on
its own when the size statistics allow it. A hot product, seller or customer is
left to adaptive execution, which splits skewed sort-merge partitions; every
such join is followed by an exchange, so splitting costs no extra shuffle.

Texts are far longer than the rest of a row. Where they come apart from their
reviews, rows carry the id of a text through all joins and get the text last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.functions import times
from cartpulse.functions.measures import money_units
from cartpulse.operators.imputation import impute
from cartpulse.schemas import FACT, INPUTS

TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
ORDER_FIELDS = (
    "customer_id",
    "order_status",
    *TIMESTAMPS,
    "delivery_delay_days",
    "shipping_duration_days",
    "approval_delay_hours",
    "is_late_delivery",
    "order_hour_of_day",
    "order_day_of_week",
)
# Of these, what is NULL without an order and made of its times alone.
MADE_OF_TIMES = (
    "delivery_delay_days",
    "shipping_duration_days",
    "approval_delay_hours",
    "order_hour_of_day",
    "order_day_of_week",
)
CUSTOMER_FIELDS = (
    "customer_unique_id",
    "customer_city",
    "customer_state",
    "customer_zip_code_prefix",
)
PAYMENT_FIELDS = ("payment_type", "payment_installments", "payment_value")
REVIEW_FIELDS = ("review_score", "review_comment_message")
PER_ORDER = ("orders", "order_items", "order_payments", "order_reviews", "review_keys")
TEXT, TEXT_ID = "review_comment_message", "text_id"
# Different texts of up to so many bytes are sent to all tasks, more meet their rows in a shuffle.
TEXT_BYTES_TO_SEND = 64 << 20
PRODUCT_FIELDS = ("product_category_name", "product_category_name_english", "product_weight_g")
SELLER_FIELDS = ("seller_city", "seller_state", "seller_zip_code_prefix")


class Inputs:
    """The eight input tables; given as functions they are opened on first use.

    The texts of reviews may be given apart, too: ``review_keys`` are the reviews with a
    ``text_id`` in place of the text, ``review_texts`` the text of every id, once. What these
    take at most may be said by ``text_bytes``, where it costs less than reading them.
    """

    def __init__(
        self,
        text_bytes: Callable[[], int] | None = None,
        **tables: DataFrame | Callable[[], DataFrame],
    ) -> None:
        apart = {"review_keys", "review_texts"} & set(tables)
        unknown = set(tables) - apart ^ set(INPUTS)
        if unknown:
            raise ValueError(f"inputs do not match the eight tables: {sorted(unknown)}")
        if len(apart) == 1:
            raise ValueError("review_keys and review_texts are given together")
        self.texts_apart = bool(apart)
        self._tables = tables
        self._text_bytes = text_bytes

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        found = self._tables[name]
        if not isinstance(found, DataFrame):
            found = self._tables[name] = found()
        return found


    @cached_property
    def sends_texts(self) -> bool:
        """Whether the texts that are given apart are few enough to be sent to all tasks."""
        if self.texts_apart and self._text_bytes is not None:
            return self._text_bytes() <= TEXT_BYTES_TO_SEND
        return self.texts_apart and may_be_sent(self.review_texts)


def of_orders(inputs: Inputs, ids: DataFrame) -> Inputs:
    """The inputs with the rows of some orders, few enough to be sent to all tasks."""

    def opened(name: str) -> Callable[[], DataFrame]:
        if name not in PER_ORDER:
            return lambda: getattr(inputs, name)
        return lambda: getattr(inputs, name).join(F.broadcast(ids), "order_id", "left_semi")

    apart = ("review_keys", "review_texts") if inputs.texts_apart else ()
    return Inputs(inputs._text_bytes, **{name: opened(name) for name in (*INPUTS, *apart)})


def bytes_of(texts: DataFrame, name: str = TEXT) -> int:
    size = F.sum(F.octet_length(name) + 64).alias("size")
    return texts.agg(size).first()["size"] or 0


def may_be_sent(texts: DataFrame, name: str = TEXT) -> bool:
    return bytes_of(texts, name) <= TEXT_BYTES_TO_SEND


def with_texts(rows: DataFrame, inputs: Inputs) -> DataFrame:
    """Rows that carry the id of a text, with the text; others as they are."""
    if TEXT_ID not in rows.columns:
        return rows
    if inputs.sends_texts:
        return rows.join(F.broadcast(inputs.review_texts), TEXT_ID, "left").drop(TEXT_ID)
    return join_spread(rows, inputs.review_texts, "order_id")


def join_spread(rows: DataFrame, texts: DataFrame, by: str) -> DataFrame:
    """Rows with the text of their id; those without one are spread over the tasks by ``by``.

    In a shuffle they would all go to one task otherwise. The ids of texts are 0 or more.
    """
    spread = -1 - F.shiftrightunsigned(F.xxhash64(by), 1)
    keyed = rows.withColumn(TEXT_ID, F.coalesce(TEXT_ID, spread))
    return keyed.join(texts, TEXT_ID, "left").drop(TEXT_ID)


def payments_per_order(payments: DataFrame) -> DataFrame:
    """One row per order: first known payment type, most installments, total value."""
    # payments without a number come last, then by type: a missing order loses no type
    number = F.col("payment_sequential")
    known = F.when(
        F.col("payment_type").isNotNull(), F.struct(number.isNull(), number, "payment_type")
    )
    return payments.groupBy("order_id").agg(
        F.min_by("payment_type", known).alias("payment_type"),
        F.max("payment_installments").alias("payment_installments"),
        (F.coalesce(F.sum(money_units(F.col("payment_value"))), F.lit(0)) / F.lit(10_000.0)).alias(
            "payment_value"
        ),
    )


def latest_reviews(reviews: DataFrame, fields: Iterable[str] = REVIEW_FIELDS) -> DataFrame:
    """The newest review of every order; an undated review counts as newest.

    A grouped ``max_by`` rather than a window: since the result is unique by
    construction Catalyst may drop an unused join to it. It sorts its rows, so they
    are spread by order first: a task then sorts its part of a shuffle, not whatever
    a piece of the input has become.
    """
    newest = F.struct(
        F.col("review_creation_date").isNull(), F.col("review_creation_date"), F.col("review_id")
    )
    return (
        reviews.repartition("order_id")
        .groupBy("order_id")
        .agg(*[F.max_by(name, newest).alias(name) for name in fields])
    )


def newest_reviews(inputs: Inputs) -> DataFrame:
    """``latest_reviews`` of the inputs, without texts on the way where they come apart."""
    if not inputs.texts_apart:
        return latest_reviews(inputs.order_reviews)
    newest = latest_reviews(inputs.review_keys, ("review_score", TEXT_ID))
    return with_texts(newest, inputs).select("order_id", *REVIEW_FIELDS)


def products_in_english(products: DataFrame, translation: DataFrame) -> DataFrame:
    return products.join(translation, "product_category_name", "left")


def with_order_measures(orders: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
    """Delays, durations, late flag and calendar parts of an order, or some of them."""
    delay = times.days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    made = {
        "delivery_delay_days": delay,
        "shipping_duration_days": times.days_between(
            "order_delivered_carrier_date", "order_delivered_customer_date"
        ),
        "approval_delay_hours": times.hours_between("order_purchase_timestamp", "order_approved_at"),
        # an order that was never delivered is not late
        "is_late_delivery": F.coalesce((delay > 0).cast("int"), F.lit(0)),
        "order_hour_of_day": F.hour("order_purchase_timestamp"),
        "order_day_of_week": F.weekday("order_purchase_timestamp"),
    }
    wanted = set(made if only is None else only)
    return orders.select("*", *[value.alias(name) for name, value in made.items() if name in wanted])


def _order_sources(inputs: Inputs, wanted: set[str]) -> list[DataFrame]:
    """The relations unique by ``order_id`` that hold the wanted columns, texts that come
    apart as their ids."""
    sources = []
    order_side = wanted.intersection((*ORDER_FIELDS, *CUSTOMER_FIELDS))
    paid, reviewed = wanted.intersection(PAYMENT_FIELDS), wanted.intersection(REVIEW_FIELDS)
    if order_side:
        orders = with_order_measures(inputs.orders)
        if wanted.intersection(CUSTOMER_FIELDS):
            orders = orders.join(
                inputs.customers.select("customer_id", *CUSTOMER_FIELDS), "customer_id", "left"
            )
        sources.append(orders.select("order_id", *_ordered(order_side)))
    if paid:
        payments = payments_per_order(inputs.order_payments)
        sources.append(payments.select("order_id", *_ordered(paid)))
    if reviewed and TEXT in reviewed and inputs.texts_apart:
        reviews = latest_reviews(inputs.review_keys, ("review_score", TEXT_ID))
        sources.append(reviews.select("order_id", *_ordered(reviewed - {TEXT}), TEXT_ID))
    elif reviewed and inputs.texts_apart and TEXT not in reviewed:
        sources.append(latest_reviews(inputs.review_keys, _ordered(reviewed)))
    elif reviewed:
        sources.append(newest_reviews(inputs).select("order_id", *_ordered(reviewed)))
    return sources


def _left_join_all(base: DataFrame, sources: Iterable[DataFrame]) -> DataFrame:
    for source in sources:
        base = base.join(source, "order_id", "left")
    return base


def _join_order_side(
    items: DataFrame, inputs: Inputs, wanted: set[str], unsent_last: bool = False
) -> DataFrame:
    """Left-join the order side to item rows, in a single join.

    Texts that are not sent join the order side last, so that they move with it once; with
    ``unsent_last`` they are left as their ids.

    Several sources are first joined to the order ids of the items, where every
    key is unique. Then comes the one join that may meet a hot order. Adaptive
    execution splits it only if both sides come straight from an exchange, so
    the key is rebuilt: Spark no longer knows the rows as hashed by it and puts
    an exchange there. (A plain ``repartition`` would be optimised away.)
    """
    sources = _order_sources(inputs, wanted)
    if not sources:
        return items
    if len(sources) == 1 and not wanted.intersection((*PAYMENT_FIELDS, *REVIEW_FIELDS)):
        return items.join(sources[0], "order_id", "left")
    ids = inputs.order_items.select("order_id").distinct()
    side = _left_join_all(ids, sources)
    if not (unsent_last or inputs.sends_texts):
        side = with_texts(side, inputs)
    side = side.withColumn("order_id", F.concat("order_id", F.lit("")))
    return items.join(side, "order_id", "left")


def _join_dimensions(items: DataFrame, inputs: Inputs, wanted: set[str]) -> DataFrame:
    """Left-join what hangs on the product or the seller of an item."""
    if wanted.intersection(PRODUCT_FIELDS):
        products = products_in_english(inputs.products, inputs.category_translation)
        items = items.join(products.select("product_id", *PRODUCT_FIELDS), "product_id", "left")
    if wanted.intersection(SELLER_FIELDS):
        items = items.join(
            inputs.sellers.select("seller_id", *SELLER_FIELDS), "seller_id", "left"
        )
    return items


def _ordered(names: Iterable[str]) -> list[str]:
    chosen = set(names)
    return [name for name in FACT.fieldNames() if name in chosen]


def _item_value() -> Column:
    return F.col("price") + F.col("freight_value")


def item_fact(
    inputs: Inputs, columns: Iterable[str] | None = None, ingested_date: str | None = None
) -> DataFrame:
    """One row per order item, with the requested columns of the 36-column fact.

    Timestamps stay timestamps; the warehouse writer turns them into text.
    """
    wanted = set(FACT.fieldNames() if columns is None else columns)
    rows = with_texts(_joined(inputs, wanted, unsent_last=True), inputs)
    return _as_fact(rows, wanted, ingested_date)


def fact_by_text(
    inputs: Inputs, columns: Iterable[str] | None = None, ingested_date: str | None = None
) -> DataFrame:
    """``item_fact``, but with the ids of texts that are to be sent; ``with_texts`` adds them.

    The rows come by order, also those with texts that are not sent.
    """
    wanted = set(FACT.fieldNames() if columns is None else columns)
    return _as_fact(_joined(inputs, wanted), wanted, ingested_date)


def _made_late(wanted: set[str]) -> set[str]:
    """Measures of an order that need not move with the rows, since what they are made of does."""
    return wanted.intersection(MADE_OF_TIMES) if wanted.issuperset(TIMESTAMPS) else set()


def _joined(inputs: Inputs, wanted: set[str], unsent_last: bool = False) -> DataFrame:
    """Item rows with all wanted columns that are not made of others.

    ``unsent_last`` leaves the ids of all texts that come apart. Those that are not sent cost
    a shuffle of the rows; otherwise they come with their orders.
    """
    read = wanted - _made_late(wanted)
    df = _join_dimensions(inputs.order_items, inputs, read)
    return _join_order_side(df, inputs, read, unsent_last)


def _as_fact(df: DataFrame, wanted: set[str], ingested_date: str | None) -> DataFrame:
    made = _made_late(wanted)
    if made:
        df = with_order_measures(df.drop(*made), made)
    day = F.current_date() if ingested_date is None else F.lit(ingested_date)
    derived = {
        "total_item_value": _item_value(),
        "ingested_date": day.cast("string"),
    }
    names = _ordered(wanted)
    if TEXT_ID in df.columns:
        names = [TEXT_ID if name == TEXT else name for name in names]
    return df.select(
        *[derived[name].alias(name) if name in derived else F.col(name) for name in names]
    )


def clean_items(
    inputs: Inputs, columns: Iterable[str] | None = None, ingested_date: str | None = None
) -> DataFrame:
    """Imputed item-grain rows plus the additive columns the measures expect."""
    wanted = None if columns is None else {*columns, "order_id", "price", "freight_value"}
    return as_item_grain(impute(item_fact(inputs, wanted, ingested_date)))


def as_item_grain(clean_fact: DataFrame) -> DataFrame:
    return clean_fact.select(
        "*",
        F.lit(1).cast("long").alias("n_items"),
        money_units(F.col("price")).alias("price_units"),
        money_units(F.col("freight_value")).alias("freight_units"),
    )


def _summed(items: DataFrame, keys: Iterable[str], *attributes: Column) -> DataFrame:
    return items.groupBy("order_id", *keys).agg(
        F.sum("n_items").alias("n_items"),
        F.sum("price_units").alias("price_units"),
        F.sum("freight_units").alias("freight_units"),
        *attributes,
    )


def clean_lines(
    inputs: Inputs,
    keys: Iterable[str],
    columns: Iterable[str] = (),
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Imputed rows per order and ``keys`` (item-level columns or ``derived`` ones).

    ``columns`` names whatever else is read: order-level columns, which are
    joined after the items are summed, and sources of the derived keys.

    The order id is left as it is, because the joins would lose their common
    partitioning otherwise. A missing id is a group of its own either way.
    """
    wanted = {*keys, *columns}
    items = impute(_join_dimensions(inputs.order_items, inputs, wanted), skip=("order_id",))
    lines = _summed(as_item_grain(items).withColumns(dict(derived or {})), [*keys, *(derived or {})])
    joined = with_texts(_left_join_all(lines, _order_sources(inputs, wanted)), inputs)
    return impute(joined, skip=("order_id",))


def clean_orders(inputs: Inputs, columns: Iterable[str] = ()) -> DataFrame:
    """Imputed rows per order that has items."""
    return clean_lines(inputs, (), columns)


def lines_from_fact(
    clean_fact: DataFrame,
    keys: Iterable[str],
    columns: Iterable[str] = (),
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Order lines from a stored fact; no shuffle if it is bucketed by order."""
    items = as_item_grain(clean_fact).withColumns(dict(derived or {}))
    grouped = [*keys, *(derived or {})]
    other = [name for name in dict.fromkeys(columns) if name not in {"order_id", *grouped}]
    return _summed(items, grouped, *[F.any_value(name).alias(name) for name in other])
