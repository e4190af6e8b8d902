"""Additive measures and the roll-up that evaluates them.

Every measure is a set of additive parts (sums of longs, minima, maxima) and a
final expression over the summed parts. That gives two things at scale:

* each shuffle is preceded by a map-side combine, also when distinct counts are
  involved, so a hot key costs one partial row per task and never a hot reducer;
* money and durations are summed as fixed-point longs, so a result does not
  depend on the order in which shuffle blocks arrive or on task retries.

Input rows carry ``n_items`` (how many order items the row stands for),
``price_units`` and ``freight_units``; item-grain rows have ``n_items = 1``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money is summed in 1/10000 of the currency unit, durations in seconds.
MONEY_UNITS = 10_000
DAY_SECONDS = 86_400
# On rows that are added to or taken from kept sums: 1 or -1.
SIGN = "_sign"
ROWS = "_rows"


@dataclass(frozen=True)
class Measure:
    final: Callable[[], Column]
    parts: Mapping[str, tuple[str, Column]] = field(default_factory=dict)


def money_units(amount: Column) -> Column:
    return F.rint(amount * F.lit(float(MONEY_UNITS))).cast("long")


def _sum(expr: Column) -> tuple[str, Column]:
    return "sum", expr


def _n() -> Column:
    return F.col("n_items")


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def _weight_if(condition: Column) -> Column:
    return F.when(condition, _n()).otherwise(F.lit(0).cast("long"))


# ------------------------------------------------------------------ measures


def items() -> Measure:
    return Measure(lambda: _zero("n"), {"n": _sum(_n())})


def rows() -> Measure:
    """Orders, when each input row is an order or a line of one."""
    return Measure(lambda: _zero("rows"), {"rows": _sum(F.lit(1).cast("long"))})


def distinct(column: str) -> Measure:
    """Distinct values of a column named in ``roll_up(..., through=...)``."""
    return Measure(lambda: _zero(f"distinct_{column}"))


def total(kind: str) -> Measure:
    """Sum of ``price`` or ``freight``."""
    name = f"{kind}_units"
    return Measure(lambda: F.col(name) / F.lit(float(MONEY_UNITS)), {name: _sum(F.col(name))})


def mean_money(kind: str) -> Measure:
    """Average ``price`` or ``freight`` per item."""
    name = f"{kind}_units"
    return Measure(
        lambda: _ratio(F.col(name), F.col("n") * F.lit(MONEY_UNITS)),
        {name: _sum(F.col(name)), "n": _sum(_n())},
    )


def mean(column: str, where: Column | None = None, tag: str = "all") -> Measure:
    """Item-weighted average of an integer column; NULLs do not count."""
    seen = F.col(column).isNotNull() if where is None else (where & F.col(column).isNotNull())
    top, bottom = f"{column}_{tag}_sum", f"{column}_{tag}_n"
    return Measure(
        lambda: _ratio(F.col(top), F.col(bottom)),
        {
            top: _sum(F.when(seen, F.col(column) * _n())),
            bottom: _sum(_weight_if(seen)),
        },
    )


def mean_days(column: str) -> Measure:
    """Item-weighted average of a duration in days; NULLs do not count."""
    seconds = F.rint(F.col(column) * F.lit(float(DAY_SECONDS))).cast("long")
    top, bottom = f"{column}_s", f"{column}_n"
    return Measure(
        lambda: _ratio(F.col(top), F.col(bottom) * F.lit(DAY_SECONDS)),
        {
            top: _sum(seconds * _n()),
            bottom: _sum(_weight_if(F.col(column).isNotNull())),
        },
    )


def payment_total(once_per_order: bool = False) -> Measure:
    """Order payment summed over items, or once per order on request."""
    units = money_units(F.col("payment_value"))
    return Measure(
        lambda: F.col("payment_units") / F.lit(float(MONEY_UNITS)),
        {"payment_units": _sum(units if once_per_order else units * _n())},
    )


def payment_mean(once_per_order: bool = False) -> Measure:
    bottom = F.lit(1).cast("long") if once_per_order else _n()
    return Measure(
        lambda: _ratio(F.col("payment_units"), F.col("payment_n") * F.lit(MONEY_UNITS)),
        {**payment_total(once_per_order).parts, "payment_n": _sum(bottom)},
    )


def hits(condition: Column, tag: str) -> Measure:
    """Items meeting a condition."""
    return Measure(lambda: _zero(f"hit_{tag}"), {f"hit_{tag}": _sum(_weight_if(condition))})


def share(condition: Column, tag: str, digits: int = 2) -> Measure:
    """Percentage of items meeting a condition: hits / items * 100."""
    return Measure(
        lambda: F.round(_ratio(F.col(f"hit_{tag}"), F.col("n")) * F.lit(100.0), digits),
        {**hits(condition, tag).parts, "n": _sum(_n())},
    )


def percent_of(condition: Column, tag: str, base: Column, base_tag: str, digits: int) -> Measure:
    """Percentage of the ``base`` items meeting a condition: hits * 100 / base."""
    return Measure(
        lambda: F.round(
            _ratio(F.col(f"hit_{tag}") * F.lit(100.0), F.col(f"hit_{base_tag}")), digits
        ),
        {**hits(condition, tag).parts, **hits(base, base_tag).parts},
    )


def basket(orders: Measure) -> Measure:
    """Items per order."""
    return Measure(
        lambda: _ratio(F.col("n"), orders.final()), {**orders.parts, "n": _sum(_n())}
    )


def least(column: str) -> Measure:
    return Measure(lambda: F.col(f"min_{column}"), {f"min_{column}": ("min", F.col(column))})


def greatest(column: str) -> Measure:
    return Measure(lambda: F.col(f"max_{column}"), {f"max_{column}": ("max", F.col(column))})


def count_where(condition: Column, tag: str) -> Measure:
    """Rows of the last but one roll-up level meeting a condition (see ``roll_up``)."""
    return Measure(lambda: _zero(f"level_{tag}"), {f"level_{tag}": ("level", condition)})


# ------------------------------------------------------------------ evaluation

_AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max}


def roll_up(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    through: Sequence[str] = (),
) -> DataFrame:
    """Group ``df`` by ``keys`` and evaluate ``measures``.

    ``through`` lists columns whose distinct values are wanted, outermost first;
    each must be determined by the next one (an order belongs to one customer).
    The rows are first combined per (keys, through) and then one column is
    dropped per step, so the distinct counts are plain counts and no row is
    multiplied, however many distinct counts are asked for. NULL counts as a
    value, as the filled-in sentinel does.

    Within ``kept_by`` the keeper answers instead.
    """
    keeper = _KEEPER.get()
    if keeper is not None:
        return keeper.rolled(df, keys, measures, through)
    plain, _ = _parts(measures)
    aggregates = [_AGGREGATES[kind](expr).alias(name) for name, (kind, expr) in plain.items()]
    if through and not aggregates:
        aggregates = [F.count(F.lit(1)).alias(ROWS)]
    return _evaluated(df.groupBy(*keys, *through).agg(*aggregates), keys, measures, through)


def _parts(
    measures: Mapping[str, Measure],
) -> tuple[dict[str, tuple[str, Column]], dict[str, Column]]:
    """(additive parts, conditions on the last but one level) of all measures."""
    parts: dict[str, tuple[str, Column]] = {}
    for measure in measures.values():
        parts.update(measure.parts)
    level = {name: expr for name, (kind, expr) in parts.items() if kind == "level"}
    return {name: part for name, part in parts.items() if part[0] != "level"}, level


def _evaluated(
    grouped: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    through: Sequence[str],
) -> DataFrame:
    """From parts per (keys, through) to the measures per keys."""
    plain, level = _parts(measures)

    def combine(kind: str, name: str) -> Column:
        return _AGGREGATES[kind](F.col(name)).alias(name)

    counted: list[str] = []
    for depth in range(len(through) - 1, -1, -1):
        dropped = through[depth]
        step = [combine(kind, name) for name, (kind, _) in plain.items()]
        step += [F.sum(name).alias(name) for name in counted]
        step.append(F.count(F.lit(1)).alias(f"distinct_{dropped}"))
        if depth == 0:
            step += [
                F.sum(F.when(expr, 1).otherwise(0)).cast("long").alias(name)
                for name, expr in level.items()
            ]
        grouped = grouped.groupBy(*keys, *through[:depth]).agg(*step)
        counted.append(f"distinct_{dropped}")
    return grouped.select(*keys, *[m.final().alias(name) for name, m in measures.items()])


# ------------------------------------------------------------------ kept sums


class Keeper(Protocol):
    """Stands in for roll-ups and sums while it is in force."""

    def rolled(
        self,
        df: DataFrame,
        keys: Sequence[str],
        measures: Mapping[str, Measure],
        through: Sequence[str],
    ) -> DataFrame:
        """The result of ``roll_up``."""

    def summed(self, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The result of ``kept_sums``."""


_KEEPER: ContextVar[Keeper | None] = ContextVar("keeper", default=None)


@contextmanager
def kept_by(keeper: Keeper) -> Iterator[None]:
    token = _KEEPER.set(keeper)
    try:
        yield
    finally:
        _KEEPER.reset(token)


def kept_sums(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums per ``keys``: as they are, or with those of other days where they are kept."""
    keeper = _KEEPER.get()
    return counts if keeper is None else keeper.summed(counts, keys)


def signed(column: str, df: DataFrame) -> Column:
    """A weight, less than 0 on a row that is taken back."""
    return F.col(column) * F.col(SIGN) if SIGN in df.columns else F.col(column)


def _extremes(plain: Mapping[str, tuple[str, Column]]) -> dict[str, tuple[str, str, Column]]:
    """Part -> (aggregate, column its values are kept in, expression); a column once for both ends."""
    return {
        name: (kind, f"_of_{name.split('_', 1)[1]}", expr)
        for name, (kind, expr) in plain.items()
        if kind != "sum"
    }


def partial_sums(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    through: Sequence[str] = (),
) -> DataFrame:
    """What rows with a ``SIGN`` add to the sums of ``roll_up``, per key and value of ``through``.

    All of it can be added up and taken back: a distinct count keeps its values with the
    rows that have them, a minimum or maximum likewise. What adds nothing is left out.
    """
    plain, _ = _parts(measures)
    values = {column: expr for _, column, expr in _extremes(plain).values()}
    sums = {name: expr for name, (kind, expr) in plain.items() if kind == "sum"}
    sign = F.col(SIGN)
    grouped = df.groupBy(*keys, *through, *[e.alias(name) for name, e in values.items()]).agg(
        F.sum(sign).alias(ROWS), *[F.sum(e * sign).alias(name) for name, e in sums.items()]
    )
    return _that_add(grouped, [ROWS, *sums])


def _that_add(sums: DataFrame, names: Sequence[str]) -> DataFrame:
    adds = F.lit(False)
    for name in names:
        adds = adds | (F.coalesce(F.col(name), F.lit(0)) != 0)
    return sums.filter(adds)


def merged_sums(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of several days as those of one."""
    names = [name for name in sums.columns if name not in keys]
    return _that_add(
        sums.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names]), names
    )


def state_keys(
    keys: Sequence[str], measures: Mapping[str, Measure], through: Sequence[str] = ()
) -> list[str]:
    """The columns of ``partial_sums`` that are no sums."""
    plain, _ = _parts(measures)
    return [*dict.fromkeys([*keys, *through, *[c for _, c, _ in _extremes(plain).values()]])]


def from_partial_sums(
    sums: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    through: Sequence[str] = (),
) -> DataFrame:
    """The roll-up of all rows whose ``partial_sums`` are given, of any number of days."""
    plain, _ = _parts(measures)
    extremes = _extremes(plain)
    names = [name for name, (kind, _) in plain.items() if kind == "sum"]
    present = merged_sums(sums, state_keys(keys, measures, through)).filter(F.col(ROWS) > 0)
    grouped = present.groupBy(*keys, *through).agg(
        F.sum(ROWS).alias(ROWS),
        *[F.sum(name).alias(name) for name in names],
        *[_AGGREGATES[kind](column).alias(name) for name, (kind, column, _) in extremes.items()],
    )
    return _evaluated(grouped, keys, measures, through)
