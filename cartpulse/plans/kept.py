"""Tables kept by partial sums, refreshed from one day's delivery.

A day delivers rows of any of the eight inputs; a row takes the place of rows of its key
that earlier days delivered. ``refresh`` joins only the orders that the delivery touches
and adds, for every table, what they add to its sums less what their earlier version
added. ``KeptMart`` adds the days up when a table is read. Sums, counts of distinct
customers and first and last dates all come out as from a run over everything.

What a refresh reads:

* the delivery;
* the ids of touched orders of earlier days (one narrow column), which say in which days'
  folders the earlier rows of these orders are; other days' inputs, facts and sums are
  not opened;
* the dimension tables, since touched items and orders are joined to them. A dimension row
  that orders were waiting for, or one that differs from the one before, touches the
  orders that refer to it; only for the latter are key columns of earlier facts read.

Texts are stored once per day and different text; stored reviews and facts have the
digest of a text in its column. Only a table that counts words reads the texts, of the
days whose orders it reads, and only after rows are summed per order.

Every run writes into a folder of its own and commits the day at the end: a run that fails
leaves nothing a reader sees, and a day that is run again replaces itself. Days are run in
order. A missing order id is one order that has no name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartpulse.functions import measures as M
from cartpulse.operators.fact import (
    TEXT,
    TEXT_ID,
    TIMESTAMPS,
    Inputs,
    as_item_grain,
    item_fact,
    lines_from_fact,
    may_be_sent,
)
from cartpulse.operators.imputation import impute
from cartpulse.plans.mart import Mart
from cartpulse.plans.tables import BUILDERS
from cartpulse.schemas import FACT, INPUTS
from cartpulse.sources import commits

DAY = "_day"
# Rows of the stored files take many times their space in memory. Spark sends what it takes
# to be small to all tasks, by way of the driver, and knows the size of files only.
_SIZE_OF_ROWS, TIMES_THEIR_FILE = "spark.sql.sources.fileCompressionFactor", 16
KEYS = {
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("order_id", "review_id"),
    "products": ("product_id",),
    "customers": ("customer_id",),
    "sellers": ("seller_id",),
    "category_translation": ("product_category_name",),
}
OF_ORDERS = [name for name, keys in KEYS.items() if keys[0] == "order_id"]
# A dimension's key is the column of the fact that refers to it.
DIMENSIONS = {name: keys[0] for name, keys in KEYS.items() if name not in OF_ORDERS}
# Tables with sums of their own; the others are read off these or off the fact.
KEPT = (
    "data_quality_report",
    "category_summary",
    "hourly_activity",
    "review_analysis",
    "delivery_performance",
    "seller_performance",
    "customer_loyalty_rfm",
    "geographic_analysis",
    "payment_analysis",
    "sales_forecasting",
    "daily_summary",
    "products_performance",
    "hourly_capacity",
    "top_bad_review_words",
    "monthly_review_trend",
    "review_root_cause_matrix",
    "seller_state_review",
    "monthly_delivery_accuracy",
    "review_score_shift",
    "tfidf_review_keywords",
)
Builders = Mapping[str, Callable[[Mart], DataFrame]]


def _renamed(rows: DataFrame) -> DataFrame:
    """The same rows under other names, so that both sides of a join may have one source."""
    return rows.select(*[F.col(name).alias(f"_of_{name}") for name in rows.columns])


def _same(*keys: str) -> Column:
    return reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys])


def _only(rows: DataFrame, of: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with keys that ``of`` has; a missing one is a key, too."""
    return rows.join(_renamed(of.select(*keys)), _same(*keys), "left_semi")


def _by_contract(rows: DataFrame, name: str) -> DataFrame:
    """The columns of an input's contract; one that is not delivered is NULL."""
    given = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in INPUTS[name]
        ]
    )


def digest() -> Column:
    return F.sha2(F.col(TEXT).cast("binary"), 256)


def _texts_of(reviews: DataFrame) -> DataFrame:
    """The different texts by their digest, combined before they are shuffled."""
    named = reviews.filter(F.col(TEXT).isNotNull()).select(digest().alias(TEXT_ID), TEXT)
    return named.distinct()


def newest_of_key(rows: DataFrame, keys: Sequence[str], day: str = DAY) -> DataFrame:
    """Of every key the rows that the last day to name it delivered; one shuffle of the rows."""
    last = F.max(day).over(Window.partitionBy(*keys))
    return rows.withColumn("_last", last).filter(F.col(day) == F.col("_last")).drop("_last")


class Store:
    """The folders of a base path; ``builders`` swaps builders of tables, ``tables`` names those kept."""

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        builders: Builders | None = None,
        tables: Sequence[str] = KEPT,
    ) -> None:
        self.spark, self.base, self.tables = spark, base, tables
        self.builders = {**BUILDERS, **(builders or {})}
        if _SIZE_OF_ROWS not in spark.conf.getAll:
            spark.conf.set(_SIZE_OF_ROWS, TIMES_THEIR_FILE)

    def days(self) -> dict[str, str]:
        return commits.committed(self.spark, self.base)

    def read(self, kind: str, folders: Iterable[str], schema: str | None = None) -> DataFrame:
        """One kind of rows of some days' folders, no others."""
        paths = [f"{self.base}/{folder}/{kind}" for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(*paths)

    def write(self, rows: DataFrame, folder: str, kind: str) -> DataFrame:
        rows.write.option("compression", "zstd").parquet(f"{self.base}/{folder}/{kind}")
        return self.read(kind, [folder])

    def input(self, name: str, folders: Iterable[str]) -> DataFrame:
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in INPUTS[name])
        return self.read(f"inputs/{name}", folders, f"{schema}, {DAY} string")

    def facts(self, folders: Iterable[str]) -> DataFrame:
        kinds = {f.name: f.dataType.simpleString() for f in FACT}
        kinds |= dict.fromkeys(TIMESTAMPS, "timestamp_ntz")
        return self.read("fact", folders, ", ".join(f"{n} {kind}" for n, kind in kinds.items()))

    def touched(self, folders: Iterable[str]) -> DataFrame:
        return self.read("touched", folders, f"order_id string, {DAY} string")

    def with_texts(self, rows: DataFrame, folders: Iterable[str]) -> DataFrame:
        """Rows with the texts that their digests stand for."""
        texts = self.read("texts", folders, f"{TEXT_ID} string, {TEXT} string")
        # a text that came on several days is one
        texts = texts.distinct().withColumnRenamed(TEXT, "_text")
        if may_be_sent(texts, "_text"):
            texts = F.broadcast(texts)
        columns = [F.col("_text").alias(c) if c == TEXT else F.col(c) for c in rows.columns]
        # rows without a text are spread by digests that no text has
        key = F.coalesce(TEXT, F.concat(F.lit("-"), F.xxhash64(*rows.columns).cast("string")))
        return rows.join(texts, key == F.col(TEXT_ID), "left").select(*columns)

    # -------------------------------------------------------------- refresh

    def refresh(self, delivery: Inputs, day: str) -> None:
        """Add a day. It must not lie before a committed one; the last one may be repeated."""
        known = self.days()
        if known and day < max(known):
            raise ValueError(f"{max(known)} is committed, {day} comes before it")
        earlier = {name: folder for name, folder in known.items() if name < day}
        folder = commits.new_folder(f"day={day}")
        delivered = {}
        for name in INPUTS:
            rows = _by_contract(getattr(delivery, name), name).withColumn(DAY, F.lit(day))
            if name == "order_reviews":
                self.write(_texts_of(rows), folder, "texts")
                rows = rows.withColumn(TEXT, digest())
            delivered[name] = self.write(rows, folder, f"inputs/{name}")
        ids = [delivered[name].select("order_id") for name in OF_ORDERS]
        ids += [self._referring(name, delivered[name], earlier) for name in DIMENSIONS]
        every = reduce(DataFrame.unionByName, ids).distinct()
        touched = self.write(every.withColumn(DAY, F.lit(day)), folder, "touched")

        before = _only(self.touched(earlier.values()), touched, "order_id")
        before = self.write(
            before.groupBy("order_id").agg(F.max(DAY).alias("ingested_date")), folder, "before"
        )
        hit = self.days_of(touched, earlier)
        new = self.write(
            item_fact(self._touched_inputs(touched, [*hit, folder], [*earlier.values(), folder]), None, day),
            folder,
            "fact",
        )
        old = self.write(
            _only(self.facts(hit), before, "order_id", "ingested_date"), folder, "replaced"
        )
        for name, key in DIMENSIONS.items():
            present = self.input(name, [*earlier.values(), folder]).select(key).distinct()
            waits = new.select("order_id", key).filter(F.col(key).isNotNull()).distinct()
            self.write(waits.join(present, key, "left_anti"), folder, f"waiting/{name}")

        delta = _DeltaMart(self, [(new, 1), (old, -1)], day, [*hit, folder])
        for name in self.tables:
            with M.kept_by(_Writer(self, folder, name)):
                self.builders[name](delta)
        commits.commit(self.spark, self.base, day, folder)

    def days_of(self, touched: DataFrame, earlier: Mapping[str, str]) -> list[str]:
        """Folders that have rows of touched orders; at most one a day."""
        found = _only(self.touched(earlier.values()), touched, "order_id")
        return [earlier[row[DAY]] for row in found.select(DAY).distinct().orderBy(DAY).collect()]

    def _touched_inputs(self, touched: DataFrame, hit: list[str], every: list[str]) -> Inputs:
        """The rows that touched orders have now; the last of the folders is the day's own.

        All orders of its own rows are touched, and no key of a single day has an older row.
        """
        tables = {}
        for name, keys in KEYS.items():
            folders = hit if name in OF_ORDERS else every
            rows = self.input(name, folders)
            if len(folders) > 1:
                if name in OF_ORDERS:
                    earlier = _only(self.input(name, folders[:-1]), touched, "order_id")
                    rows = earlier.unionByName(self.input(name, folders[-1:]))
                rows = newest_of_key(rows, keys)
            tables[name] = rows.drop(DAY)
        return Inputs(**tables)

    def _referring(self, name: str, delivered: DataFrame, earlier: Mapping[str, str]) -> DataFrame:
        """Orders of earlier days that a dimension's delivery changes."""
        key = DIMENSIONS[name]
        waiting = self.read(
            f"waiting/{name}", earlier.values(), f"order_id string, {key} string"
        )
        late = _only(waiting, delivered, key).select("order_id")
        before = newest_of_key(_only(self.input(name, earlier.values()), delivered, key), [key])
        columns = [field for field in INPUTS[name].fieldNames() if field != key]
        changed = before.join(_renamed(delivered), _same(key) & ~_same(*columns), "left_semi")
        if not earlier or changed.isEmpty():
            return late
        facts = self.facts(earlier.values()).select("order_id", key)
        return late.unionByName(_only(facts, changed, key).select("order_id"))

    # -------------------------------------------------------------- compaction

    def compact(self) -> None:
        """Fold the sums of all days into one folder, so that reading opens one.

        The sums are written into a new folder, which is committed last. Rows stay as they are.
        """
        days = self.days()
        folder = commits.new_folder(f"upto={max(days)}")
        for name in self.tables:
            with M.kept_by(_Folder(self, self.state_folders(), name, folder)):
                self.builders[name](_ReadingMart(self))
        commits.commit(self.spark, f"{self.base}/compacted", days[max(days)], folder)

    def state_folders(self) -> list[str]:
        """Folders whose sums add up to the present state."""
        days = self.days()
        # named by the last day's folder, so it holds until that day is run again
        folded = commits.committed(self.spark, f"{self.base}/compacted")
        upto = max((day for day, folder in days.items() if folder in folded), default="")
        begin = [folded[days[upto]]] if upto else []
        return [*begin, *[folder for day, folder in days.items() if day > upto]]


class _Writer:
    """Writes what rows add to a table's sums."""

    def __init__(self, store: Store, folder: str, table: str) -> None:
        self.store, self.folder, self.table, self.number = store, folder, table, 0

    def kind(self) -> str:
        self.number += 1
        return f"sums/{self.table}-{self.number}"

    def rolled(self, df, keys, measures, through) -> DataFrame:
        added = M.partial_sums(df, keys, measures, through)
        return M.from_partial_sums(
            self.store.write(added, self.folder, self.kind()), keys, measures, through
        )

    def summed(self, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
        return self.store.write(M.merged_sums(counts, keys), self.folder, self.kind())


class _Reader(_Writer):
    """Answers with the sums of some folders."""

    def __init__(self, store: Store, folders: list[str], table: str) -> None:
        super().__init__(store, "", table)
        self.folders = folders

    def rolled(self, df, keys, measures, through) -> DataFrame:
        sums = self.store.read(self.kind(), self.folders)
        return M.from_partial_sums(sums, keys, measures, through)

    def summed(self, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
        return M.merged_sums(self.store.read(self.kind(), self.folders), keys)


class _Folder(_Writer):
    """Writes the sums of some folders into one."""

    def __init__(self, store: Store, folders: list[str], table: str, folder: str) -> None:
        super().__init__(store, folder, table)
        self.folders = folders

    def rolled(self, df, keys, measures, through) -> DataFrame:
        kind = self.kind()
        sums = M.merged_sums(
            self.store.read(kind, self.folders), M.state_keys(keys, measures, through)
        )
        return M.from_partial_sums(
            self.store.write(sums, self.folder, kind), keys, measures, through
        )

    def summed(self, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
        kind = self.kind()
        sums = M.merged_sums(self.store.read(kind, self.folders), keys)
        return self.store.write(sums, self.folder, kind)


class _Rows:
    """What a mart makes of stored facts; ``parts`` have a sign each, or none."""

    store: Store
    texts_in: Sequence[str]  # folders that have the texts of the rows

    def _each(self, of_part: Callable[[DataFrame], DataFrame]) -> DataFrame:
        raise NotImplementedError

    def _read(self, rows: DataFrame, columns: Iterable[str]) -> DataFrame:
        """Imputed rows; texts are read if asked for, or else left out."""
        if TEXT in columns:
            rows = self.store.with_texts(rows, self.texts_in)
        elif TEXT in rows.columns:
            rows = rows.drop(TEXT)
        return impute(rows)

    def raw_items(self, *columns: str) -> DataFrame:
        def picked(rows: DataFrame) -> DataFrame:
            found = rows.select(*columns)
            return self.store.with_texts(found, self.texts_in) if TEXT in columns else found

        return self._each(picked)

    def items(self, *columns: str) -> DataFrame:
        return self._each(lambda rows: as_item_grain(self._read(rows, columns)))

    def orders(self, *columns: str) -> DataFrame:
        return self.lines((), *columns)

    def lines(self, keys: Iterable[str], *columns: str, **derived: Column) -> DataFrame:
        listed = list(keys)
        if TEXT in listed or derived:  # may be made of the texts
            return self._each(
                lambda rows: lines_from_fact(self._read(rows, {*listed, *columns}), listed, columns, derived)
            )

        def summed(rows: DataFrame) -> DataFrame:
            # the sentinel of a missing text comes in once its digest has met the texts
            lines = lines_from_fact(impute(rows, skip=(TEXT,)), listed, columns)
            return self._read(lines, columns)

        return self._each(summed)


class _DeltaMart(_Rows):
    """New versions of orders and, with a negative sign, those they replace."""

    def __init__(
        self,
        store: Store,
        parts: list[tuple[DataFrame, int]],
        day: str | None,
        texts_in: Sequence[str] = (),
    ) -> None:
        self.store, self.parts, self.ingested_date = store, parts, day
        self.texts_in = texts_in

    def _each(self, of_part: Callable[[DataFrame], DataFrame]) -> DataFrame:
        signed = [
            of_part(rows).withColumn(M.SIGN, F.lit(sign).cast("long")) for rows, sign in self.parts
        ]
        return reduce(DataFrame.unionByName, signed)

    def table(self, name: str) -> DataFrame:
        raise ValueError(f"{name} is read off sums, it has none of its own")


class _ReadingMart(_DeltaMart):
    """No rows: what is built on them gets its sums from a keeper."""

    def __init__(self, store: Store, day: str | None = None) -> None:
        super().__init__(store, [(store.facts([]), 1)], day)


class KeptMart(_Rows):
    """A mart on a store: tables from their sums, rows from the orders' newest versions."""

    def __init__(self, store: Store, ingested_date: str | None = None) -> None:
        self.store = store
        self._days = store.days()
        self._sums = store.state_folders()
        self.texts_in = list(self._days.values())
        self.ingested_date = ingested_date or max(self._days, default=None)

    def _each(self, of_part: Callable[[DataFrame], DataFrame]) -> DataFrame:
        touched = self.store.touched(self._days.values())
        last = touched.groupBy("order_id").agg(F.max(DAY).alias("ingested_date"))
        rows = _only(self.store.facts(self._days.values()), last, "order_id", "ingested_date")
        day = F.col("ingested_date") if self.ingested_date is None else F.lit(self.ingested_date)
        return of_part(rows.withColumn("ingested_date", day))

    def table(self, name: str) -> DataFrame:
        build = self.store.builders[name]
        if name not in self.store.tables:
            return build(self)
        if not self._days:
            raise FileNotFoundError(f"no day in {self.store.base}")
        with M.kept_by(_Reader(self.store, self._sums, name)):
            return build(_ReadingMart(self.store, self.ingested_date))
