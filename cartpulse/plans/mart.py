"""Where tables and dashboards get their rows from.

``LiveMart`` derives everything from the inputs on demand, ``StoredMart`` reads
what a run has written. Both hand out the same three things, so a dashboard
query is written once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cached_property
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.operators.fact import (
    TIMESTAMPS,
    Inputs,
    as_item_grain,
    clean_items,
    clean_lines,
    clean_orders,
    item_fact,
    lines_from_fact,
)
from cartpulse.schemas import TABLES


class Mart(Protocol):
    ingested_date: str | None

    def raw_items(self, *columns: str) -> DataFrame:
        """Item rows before imputation."""

    def items(self, *columns: str) -> DataFrame:
        """Clean item rows with at least these columns."""

    def orders(self, *columns: str) -> DataFrame:
        """Clean rows per order with at least these order columns."""

    def lines(self, keys: Iterable[str], *columns: str, **derived: Column) -> DataFrame:
        """Clean rows per order and item-level keys, some of them derived."""

    def table(self, name: str) -> DataFrame:
        """A warehouse table by its unqualified name."""


class LiveMart:
    """``overrides`` swaps the builder of a table, say for one that fits no model."""

    def __init__(
        self,
        inputs: Inputs,
        ingested_date: str | None = None,
        overrides: Mapping[str, Callable[[Mart], DataFrame]] | None = None,
    ) -> None:
        self.inputs = inputs
        self.ingested_date = ingested_date
        self._overrides = dict(overrides or {})

    def raw_items(self, *columns: str) -> DataFrame:
        return item_fact(self.inputs, columns, self.ingested_date)

    def items(self, *columns: str) -> DataFrame:
        return clean_items(self.inputs, columns, self.ingested_date)

    def orders(self, *columns: str) -> DataFrame:
        return clean_orders(self.inputs, columns)

    def lines(self, keys: Iterable[str], *columns: str, **derived: Column) -> DataFrame:
        return clean_lines(self.inputs, list(keys), columns, derived)

    def table(self, name: str) -> DataFrame:
        from cartpulse.plans.tables import BUILDERS

        return self._overrides.get(name, BUILDERS[name])(self)


class StoredMart:
    """Reads the warehouse; the audit also needs the fact before imputation."""

    def __init__(
        self,
        spark: SparkSession,
        ingested_date: str | None = None,
        raw_fact: DataFrame | None = None,
    ) -> None:
        self.spark = spark
        self.ingested_date = ingested_date
        self._raw_fact = raw_fact

    @cached_property
    def _homes(self) -> dict[str, str]:
        # a name kept in both databases is read from the first one listed
        homes: dict[str, str] = {}
        for full_name in TABLES:
            homes.setdefault(full_name.split(".")[1], full_name)
        return homes

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._homes[name])

    def _fact(self) -> DataFrame:
        stored = self.table("order_items")
        return stored.withColumns(
            {name: F.expr(f"try_cast({name} as timestamp_ntz)") for name in TIMESTAMPS}
        )

    def raw_items(self, *columns: str) -> DataFrame:
        if self._raw_fact is None:
            raise ValueError("the warehouse holds no rows from before imputation")
        return self._raw_fact.select(*columns)

    def items(self, *columns: str) -> DataFrame:
        return as_item_grain(self._fact())

    def orders(self, *columns: str) -> DataFrame:
        return lines_from_fact(self._fact(), (), columns)

    def lines(self, keys: Iterable[str], *columns: str, **derived: Column) -> DataFrame:
        return lines_from_fact(self._fact(), list(keys), columns, derived)
