"""Packing documents into fixed-length token sequences, whole corpora at once.

Which pieces share a sequence depends on their lengths alone, and there are at most
``capacity`` different lengths. So Spark counts the pieces of every length, the driver
packs those counts (never more than ``capacity`` numbers, whatever the corpus), and
Spark deals the pieces of every length out to the places made for it. The plan is
that of a packer that has seen all pieces of the corpus at once.

A plan is a list of (filling, times): a filling lists (length, how many) and takes one
sequence; it is used ``times`` times.

Defined cases: a null or empty text is the end-of-document id alone; repeated rows
and equal ids are packed each; an empty table gives no rows; further columns are not
read. Only documents longer than the capacity are cut, losslessly, at multiples of it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartpulse.llm import tables
from cartpulse.llm.tokens import word_ids

CAPACITY = 2048
ROWS_PER_SHARD = 100_000
PIECE = (
    "uid bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint,"
    " ids binary"
)
Filling = tuple[tuple[int, int], ...]
Plan = list[tuple[Filling, int]]


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Pieces of every document, each with a number of its own (``uid``).

    ``ids`` is null unless asked for, then the ids as 16-bit numbers. The
    numbers follow from the partition and so are fixed once the rows are stored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer)
        uid = TaskContext.get().partitionId() << 40
        for rows in batches:
            found: list[tuple] = []
            for doc_id, text in zip(
                rows.column("doc_id").to_pylist(), rows.column("text"), strict=True
            ):
                ids = known.document(text.as_py())
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    kept = narrow(part) if with_ids else None
                    length, crc = len(part) // 4, zlib.crc32(part)
                    found.append((uid, doc_id, number, at // 4, length, crc, kept))
                    uid += 1
                if len(found) >= 4096:
                    yield _batch(found)
                    found = []
            if found:
                yield _batch(found)

    source = tables.in_small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return source.mapInArrow(run, PIECE)


def narrow(ids: bytes) -> bytes:
    """Ids as 16-bit numbers; the public vocabularies are smaller than 65,536."""
    numbers = np.frombuffer(ids, "<u4")
    if len(numbers) and numbers.max() > 0xFFFF:
        raise ValueError("the vocabulary does not fit 16-bit ids")
    return numbers.astype("<u2").tobytes()


def _batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = (*[pa.int64()] * 2, pa.int32(), *[pa.int64()] * 3, pa.binary())
    names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    columns = zip(*found, strict=True)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def length_counts(cut: DataFrame) -> dict[int, int]:
    """Pieces of every length; at most ``capacity`` rows."""
    rows = cut.groupBy("length").agg(F.count("*").alias("n")).collect()
    return {int(row["length"]): int(row["n"]) for row in rows}


class _Places:
    """From a piece's length and rank among its equals to its sequence and offset."""

    def __init__(self, plan: Plan) -> None:
        taken: dict[int, int] = {}
        entries: list[tuple[int, int, int, int, int]] = []
        first = 0
        for filling, times in plan:
            offset = 0
            for length, each in filling:
                begin = taken.get(length, 0)
                entries.append((self.key(length, begin), each, first, offset, begin))
                taken[length] = begin + each * times
                offset += each * length
            first += times
        self.taken = taken
        entries.sort()
        table = np.array(entries, dtype=np.int64).reshape(-1, 5)
        self.keys, self.each, self.first, self.offset, self.begin = table.T.copy()

    @staticmethod
    def key(length, rank):
        return (length << 48) + rank

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, self.key(length, rank), side="right") - 1
        within = rank - self.begin[at]
        each = self.each[at]
        return self.first[at] + within // each, self.offset[at] + within % each * length


def ranked(cut: DataFrame, total: int) -> DataFrame:
    """Stored pieces with their ``rank`` among those of equal length, from 0.

    A length that a third of all pieces have is spread over shards; the rank is
    the place in the shard plus the pieces of the shards before it.
    """
    shards = max(tables.tasks(cut), -(-total // ROWS_PER_SHARD))
    sharded = cut.withColumn(
        "shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")
    )
    in_shard = Window.partitionBy("length", "shard").orderBy("uid")
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        sharded.groupBy("length", "shard")
        .agg(F.count("*").alias("n"))
        .select(
            "length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("passed")
        )
    )
    return (
        sharded.withColumn("place", F.row_number().over(in_shard) - 1)
        .join(offsets, ["length", "shard"])
        .withColumn("rank", F.col("passed") + F.col("place"))
        .drop("shard", "place", "passed")
    )


def dealt(cut: DataFrame, plan_of: Callable[[dict[int, int]], Plan]) -> DataFrame:
    """Stored pieces with ``sequence_id`` and ``offset`` by the plan for their lengths."""
    counts = length_counts(cut)
    places = _Places(plan_of(counts))
    if places.taken != counts:
        raise ValueError("the plan does not place every piece")

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.find(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    found = ranked(cut, sum(counts.values())).withColumn("place", place("length", "rank"))
    return found.select("*", "place.sequence_id", "place.offset").drop("place", "rank")


def pack(
    docs: DataFrame,
    tokenizer: str,
    plan_of: Callable[[dict[int, int]], Plan],
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece with its sequence and offset."""
    cut = tables.stored(pieces(docs, tokenizer, capacity).drop("ids"), "pieces")
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return dealt(cut, plan_of).select(*names)
