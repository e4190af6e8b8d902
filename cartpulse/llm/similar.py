"""Word shingles as hashes, and which of them are seen often.

Defined cases: words are runs without white space (space, \\t \\n \\v \\f \\r), A-Z
lower-cased; a text of fewer words than a shingle is one shingle; a text without words,
or null, has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import tables

SEED = 42
SLOT_BITS = 22
MARKED = 1 << 18


def shingle_hashes(text: str | None, words_per_shingle: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    words = (text or "").encode().lower().split()
    k = words_per_shingle
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    if len(words) < k:
        shingles = iter((b" ".join(words),) if words else ())
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8")


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def frequent_slots(docs: DataFrame, words_per_shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of frequent shingles and how often they are seen, repeats included, at most ``MARKED``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int32)
        for rows in batches:
            for text in rows.column("text"):
                np.add.at(counts, slots(shingle_hashes(text.as_py(), words_per_shingle)), 1)
        often = np.flatnonzero(counts > 1 + 4 * counts.mean())
        for part in np.array_split(often, len(often) // 65_536 + 1):
            yield pa.record_batch([pa.array(part), pa.array(counts[part])], ["slot", "n"])

    found = (
        docs.select("text")
        .mapInArrow(run, "slot bigint, n int")
        .groupBy("slot")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "slot")
        .limit(MARKED)
        .toArrow()
    )
    return found["slot"].to_numpy(), found["n"].to_numpy()


def seen_often(marked: np.ndarray, counts: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """How often each of some hashes is seen, by its slot, at least 1."""
    table = np.ones(1 << SLOT_BITS, np.float32)  # counts beyond 2 ** 24 need not be exact
    table[marked] = counts
    return lambda hashes: table[slots(hashes)].astype(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return tables.in_small_batches(docs).select(
        doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("row_key"), "text"
    )
