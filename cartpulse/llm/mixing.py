"""Mixing sources to target weights by Pfair scheduling.

Every source's documents, in the order of a hash, are cut into blocks of ``block_chars``
characters: a document belongs to the block in which it begins, so a long one stands
for several. Block k of a source with weight w is released at slot floor(k / w) and due
at ceil((k + 1) / w); the slots go to the released block with the earliest deadline.
Up to any slot t a source then has had w * t blocks, less than one off.

Releases and deadlines are taken from the weights themselves, in whole numbers, over the
whole phase, so the deviation does not grow with the input. When a source has given its
last block, the weights of the rest are scaled up and a new phase begins, so there are
as many phases as sources at most and no document is left out or repeated.

The driver holds one number per block (8 bytes for ``block_chars`` characters); more than
``MAX_SOURCES`` sources are refused with an error, as their weights would be no mixture.

Defined cases: a null source is a source of its own; a null or empty text counts as
one character; repeated rows are mixed each, next to one another; an empty table
gives no rows; sources without a stated weight get the weight of their size to the
power ``temperature``; weights that are null, zero or negative are an error.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Mapping
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK_CHARS = 50_000
PERIOD = 1_000
TEMPERATURE = 0.5
MAX_SOURCES = 2_000
SHARDS = 1_024


def quotas(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights, ``period`` in all at least."""
    if not all(w and w > 0 and math.isfinite(w) for w in weights.values()):
        raise ValueError("weights must be positive")
    exact = {name: Fraction(weights[name]) for name in sorted(weights)}
    shared = math.lcm(*(w.denominator for w in exact.values()))
    whole = {name: int(w * shared) for name, w in exact.items()}
    divisor = math.gcd(*whole.values()) or 1
    times = -(-period * divisor // max(sum(whole.values()), 1))
    return {name: n // divisor * times for name, n in whole.items()}


def one_phase(quota: Mapping[str, int], left: Mapping[str, int]) -> dict[str, array]:
    """Slots of each source's blocks until one has given all it has ``left``."""
    total = sum(quota.values())
    waiting = [(0, name) for name in sorted(quota)]  # (release, source)
    ready: list[tuple[int, str]] = []  # (deadline, source)
    slots = {name: array("q") for name in quota}
    now = 0
    while True:
        while waiting and waiting[0][0] <= now:
            _, name = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(slots[name]) + 1) * total // quota[name]), name))
        due, name = heapq.heappop(ready)
        if due <= now:
            raise ValueError("a deadline is missed")
        own = slots[name]
        own.append(now)
        if len(own) == left[name]:
            return slots
        heapq.heappush(waiting, (len(own) * total // quota[name], name))
        now += 1


class Schedule:
    """Slots of all blocks of all sources."""

    def __init__(
        self, blocks: Mapping[str, int], weights: Mapping[str, float], period: int = PERIOD
    ) -> None:
        parts: dict[str, list[np.ndarray]] = {name: [] for name in blocks}
        left = {name: n for name, n in blocks.items() if n}
        base = 0
        while left:
            given = one_phase(quotas({name: weights[name] for name in left}, period), left)
            for name, slots in given.items():
                parts[name].append(np.array(slots, dtype=np.int64) + base)
                left[name] -= len(slots)
                if not left[name]:
                    del left[name]
            base += sum(map(len, given.values()))
        none = np.empty(0, dtype=np.int64)
        self.found = {name: np.concatenate([none, *own]) for name, own in parts.items()}

    def slots(self, source: str, block: np.ndarray) -> np.ndarray:
        return self.found[source][block]


def _blocked(docs: DataFrame, block_chars: int, carried: list[str]) -> DataFrame:
    """``row`` (a struct of ``carried``), ``source_key``, ``place``, ``block``.

    The running sum of characters in a source is taken in two steps, in shards of
    its hash order and over the shards, so that no task sees a whole source.
    """
    spread = docs.select(
        F.struct(*carried).alias("row"),
        # a null source apart from one called ""
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"),
        F.xxhash64("doc_id", "text").alias("place"),
        F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)).cast("long").alias("chars"),
    ).withColumn("shard", F.shiftright("place", 64 - (SHARDS.bit_length() - 1)))
    before = Window.partitionBy("source_key").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1
    )
    passed = (
        spread.groupBy("source_key", "shard")
        .agg(F.sum("chars").alias("n"))
        .select(
            "source_key",
            "shard",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("passed"),
        )
    )
    earlier = (
        Window.partitionBy("source_key", "shard")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        spread.withColumn("begun", F.coalesce(F.sum("chars").over(earlier), F.lit(0)))
        .join(passed, ["source_key", "shard"])
        .select(
            "row",
            "source_key",
            "place",
            F.floor((F.col("passed") + F.col("begun")) / F.lit(block_chars)).alias("block"),
        )
    )


def mixed(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    block_chars: int = BLOCK_CHARS,
    period: int = PERIOD,
    temperature: float = TEMPERATURE,
    carried: list[str] | None = None,
) -> DataFrame:
    """``row``, ``source_key``, ``place``, ``block``, ``slot``; the order is by slot, then place."""
    chars = F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)).cast("long")
    totals = (
        docs.groupBy(
            F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key")
        )
        .agg(F.sum(chars).alias("chars"))
        .limit(MAX_SOURCES + 1)
        .collect()
    )
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    stated = {
        "" if name is None else f"={name}": weight for name, weight in (weights or {}).items()
    }
    sizes = {row["source_key"]: row["chars"] for row in totals}
    target = {name: stated.get(name, size**temperature) for name, size in sizes.items()}
    # the last document begins before the last character
    blocks = {name: (size - 1) // block_chars + 1 for name, size in sizes.items()}
    schedule = Schedule(blocks, target, period)

    @F.pandas_udf("long")
    def slot(source: pd.Series, block: pd.Series) -> pd.Series:
        found = np.empty(len(block), dtype=np.int64)
        numbers = block.to_numpy(np.int64)
        for name, rows in source.groupby(source).indices.items():
            found[rows] = schedule.slots(name, numbers[rows])
        return pd.Series(found)

    return _blocked(docs, block_chars, carried or ["doc_id", "source"]).withColumn(
        "slot", slot("source_key", "block")
    )


def mixing_order(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """One row per document: its source, block, slot, and place within the block."""
    return mixed(docs, weights).select(
        F.col("row.doc_id"), F.col("row.source"), "block", "slot", "place"
    )


def mixing_stage(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """The documents' own columns, all rows, sorted into the mixed order."""
    ordered = mixed(docs, weights, carried=docs.columns).orderBy("slot", "place")
    return ordered.select(*[F.col("row").getField(n).alias(n) for n in docs.columns])
