"""SimHash near-dedup by multi-index hashing.

A document's fingerprint has a bit set where over half of its shingle hashes (XXH64,
seed 42, repeats count) have it. Fingerprints at most ``radius`` bits apart are
linked. The 64 bits are cut into ``segments``; two linked fingerprints are at most
``radius // segments`` bits apart in one of them, so every different fingerprint
probes the index of each segment with the small Hamming ball around its own value,
and the complete distance of what is found is verified in the join.

Equal fingerprints are folded before they are linked: a group of exact copies, however
large, is one entry of the index. A fingerprint has at most sum(C(64, i), i <= radius)
neighbours (43,744 for 3), so links grow with the fingerprints, never with the
square of a group.

Defined cases: words are runs without white space (space, \\t \\n \\v \\f \\r), A-Z
lower-cased; a text with fewer words than a shingle is one shingle, a null or empty
text or one of white space has fingerprint 0 and is linked like any other. Repeated
rows and equal ids are linked like other copies; a null ``doc_id`` stays null and is
never a component's id unless all of its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import adaptjoin, tables
from cartpulse.llm.components import components

SEED = 42
BITS = 64
_BIT_OF_BYTE = np.unpackbits(
    np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"
).astype(np.int64)
_BYTE_PLACE = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = words_per_shingle
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    if len(words) < k:
        shingles = iter((b" ".join(words),))
    return _majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8"))


def _majority(hashes: np.ndarray) -> int:
    places = hashes.view(np.uint8).reshape(-1, 8) + _BYTE_PLACE
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BIT_OF_BYTE).ravel() * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int) -> DataFrame:
    """(doc_id, row_key, fp), the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [fingerprint(t.as_py(), words_per_shingle) for t in rows.column("text")]
            yield pa.record_batch(
                [
                    rows.column("doc_id"),
                    rows.column("row_key"),
                    pa.array(np.array(found, "<u8").view("<i8")),
                ],
                ["doc_id", "row_key", "fp"],
            )

    source = tables.in_small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row_key"),
        "text",
    )
    return source.mapInArrow(run, "doc_id bigint, row_key bigint, fp bigint")


def _segments(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def _ball(width: int, radius: int) -> list[int]:
    return [
        sum(1 << bit for bit in flipped)
        for size in range(radius + 1)
        for flipped in combinations(range(width), size)
    ]


def _value(fp: Column, number: int, first: int, width: int) -> Column:
    """A segment's bits, with the segment's number above them."""
    bits = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))
    return bits.bitwiseOR(F.lit(number << 58))


def _around(value: Column, masks: list[int]) -> Column:
    return F.transform(
        F.lit(masks).cast("array<bigint>"), lambda mask: value.bitwiseXOR(mask)
    )


def links(fps: DataFrame, radius: int, segments: int) -> DataFrame:
    """Pairs (a, b) with a < b of the different fingerprints in ``fp``."""
    if not 2 <= segments <= 16:
        raise ValueError("2 to 16 segments")
    layout = list(enumerate(_segments(segments)))
    ball = radius // segments
    entries = fps.select(
        F.col("fp").alias("b"),
        F.explode(F.array(*[_value(F.col("fp"), n, *cut) for n, cut in layout])).alias("slot"),
    )
    balls = [_around(_value(F.col("fp"), n, *cut), _ball(cut[1], ball)) for n, cut in layout]
    probes = fps.select(F.col("fp").alias("a"), F.explode(F.concat(*balls)).alias("slot"))
    near = (F.col("a") < F.col("b")) & (
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    )
    return (
        probes.alias("p")
        .join(entries.alias("e"), (F.col("p.slot") == F.col("e.slot")) & near)
        .select("a", "b")
    )


def _rooted(nodes: DataFrame, roots: DataFrame, by: str) -> DataFrame:
    """``nodes`` with ``root``: that of column ``by``, itself without a link."""
    renamed = roots.withColumnsRenamed({"node": "of_node", "root": "of_root"})
    return (
        nodes.join(renamed, F.col(by) == F.col("of_node"), "left")
        .withColumn("root", F.coalesce("of_root", by))
        .drop("of_node", "of_root")
    )


def near_groups(docs: DataFrame, words_per_shingle: int, radius: int, segments: int) -> DataFrame:
    """(doc_id, row_key, fp, component_id, keeper) of every row.

    ``component_id`` is the smallest ``doc_id`` reachable over links, ``keeper`` the
    row key of one document of the component (smallest id, then smallest key).
    """
    rows = tables.stored(fingerprints(docs, words_per_shingle), "fingerprints")
    last = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    different = tables.stored(
        rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.min(last).alias("keeper")),
        "fingerprint-index",
    )
    rooted = _rooted(different, components(links(different.select("fp"), radius, segments)), "fp")
    named = rooted.groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.min("keeper").alias("least")
    )
    by_fp = (
        rooted.select("fp", "root")
        .join(named, "root")
        .select("fp", "component_id", F.col("least.row_key").alias("keeper"))
    )
    return rows.select("doc_id", "row_key", "fp").join(by_fp, "fp")


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = 3, radius: int = 3, segments: int = 2
) -> DataFrame:
    """One row per document: fingerprint in hex and component."""
    found = near_groups(docs, words_per_shingle, radius, segments)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_rows(
    docs: DataFrame, nodes: DataFrame, words_per_shingle: int = 3, radius: int = 3, segments: int = 2
) -> DataFrame:
    """Pairs (a, b) of the row keys ``node`` whose fingerprints are linked.

    Equal fingerprints are linked by way of the least of their rows, and so are those of
    linked ones: pairs of representatives and membership.
    """
    rows = fingerprints(docs, words_per_shingle).select(F.col("row_key").alias("node"), "fp")
    known = tables.stored(rows.join(nodes, "node", "left_semi").distinct(), "stage-fingerprints")
    least = tables.stored(known.groupBy("fp").agg(F.min("node").alias("least")), "stage-index")
    member = known.join(least, "fp").select(F.col("node").alias("a"), F.col("least").alias("b"))
    linked = links(least.select("fp"), radius, segments)
    for side in "ab":
        own = least.select(F.col("fp").alias(side), F.col("least").alias(f"row_{side}"))
        linked = linked.join(own, side)
    between = linked.select(F.col("row_a").alias("a"), F.col("row_b").alias("b"))
    return member.filter("a <> b").unionByName(between)


def dedup_stage(docs: DataFrame, words_per_shingle: int = 5) -> DataFrame:
    """The documents' own columns, one document of each group of similar ones.

    Multi-index hashing of fingerprints says which documents are near. They only estimate
    a similarity, so every link is verified in ``adaptjoin`` by the shingles themselves,
    4/5 or more of the different ones, and its complete join adds the pairs that
    fingerprints miss.
    """

    def proposed(nodes: DataFrame) -> DataFrame:
        return near_rows(docs, nodes)

    return adaptjoin.one_of_each_group(docs, words_per_shingle, proposed)
