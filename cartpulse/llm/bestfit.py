"""Best-fit-decreasing packing and packed id matrices.

Pieces are placed from the longest to the shortest, each in the open sequence with
the least room that holds it; a segment tree over the rooms finds it. Pieces of one
length are placed together: the sequence chosen keeps being the tightest until it
holds no further one, so the steps are the same as for one piece after another.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import packing, tables
from cartpulse.llm.packing import CAPACITY, Filling, Plan


class RoomTree:
    """Segment tree over rooms 0 .. capacity: how many open sequences have each."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.sums = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.sums[at] += n
            at //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that an open sequence has."""
        at = least + self.size
        while not self.sums[at]:
            while at % 2:  # a right child: nothing further under its parent
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self.size:
            at = 2 * at if self.sums[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    tree = RoomTree(capacity)
    opened: dict[int, list[list]] = {}  # room -> groups [filling, times]

    def put(filling: Filling, room: int, times: int) -> None:
        if times:
            opened.setdefault(room, []).append([filling, times])
            tree.add(room, times)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                filling, free, room = (), -(-left // (capacity // length)), capacity
            else:
                filling, free = opened[room].pop()
                tree.add(room, -free)
            fits = room // length
            full = min(free, left // fits)
            put((*filling, (length, fits)), room - fits * length, full)
            left -= full * fits
            free -= full
            if free and left:  # fewer than one sequence takes
                part = min(left, fits)
                put((*filling, (length, part)), room - part * length, 1)
                left -= part
                free -= 1
            if filling:
                put(filling, room, free)
    return [(filling, times) for groups in opened.values() for filling, times in groups]


PLACES_TO_SEND = 1 << 20
_MATRIX = {
    "sequence_id": "bigint",
    "n_tokens": "bigint",
    "doc_ids": "array<bigint>",
    "pieces": "array<int>",
    "cu_seqlens": "array<int>",
    "position_resets": "array<int>",
    "token_ids": "binary",
    "ids_crc32": "bigint",
}


def _lists(values: pa.Array, ends: np.ndarray) -> pa.ListArray:
    """``values`` cut after each of ``ends``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)


def _matrix(sequences: pa.Array, parts: pa.ListArray, capacity: int) -> pa.RecordBatch:
    """Rows of the id matrix from the parts of every sequence, which are in order."""
    pieces = parts.flatten()
    n_parts = np.diff(parts.offsets.to_numpy())
    ends = np.cumsum(n_parts)
    starts = pieces.field("offset").to_numpy().astype(np.int64)
    ids = pieces.field("ids")
    _, places, held = ids.buffers()
    bounds = np.frombuffer(places, np.int32)[ids.offset : ids.offset + len(ids) + 1] // 2
    numbers = np.frombuffer(held, "<u2", int(bounds[-1])) if held else np.empty(0, "<u2")
    lengths = np.diff(bounds)
    rows = np.zeros((len(n_parts), capacity), dtype="<u2")
    row_of = np.repeat(np.arange(len(n_parts)), n_parts)
    for row, at, lo, hi in zip(row_of, starts, bounds[:-1], bounds[1:], strict=True):
        rows[row, at : at + hi - lo] = numbers[lo:hi]
    tokens = (starts + lengths)[ends - 1]
    # bounds of the segments: the starts of all and the end of the last
    bounded = np.insert(starts, ends, tokens)
    return pa.record_batch(
        [
            sequences,
            pa.array(tokens, pa.int64()),
            _lists(pieces.field("doc_id"), ends),
            _lists(pieces.field("piece"), ends),
            _lists(pa.array(bounded, pa.int32()), ends + np.arange(1, len(ends) + 1)),
            _lists(pa.array(starts, pa.int32()), ends),
            pa.array([row.tobytes() for row in rows], pa.binary()),
            pa.array(
                [zlib.crc32(row[:n].astype("<u4")) for row, n in zip(rows, tokens, strict=True)],
                pa.int64(),
            ),
        ],
        list(_MATRIX),
    )


def packed_matrices(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per sequence.

    ``token_ids`` is the sequence's row of the id matrix: ``capacity`` little-endian
    unsigned 16-bit ids, 0 beyond ``n_tokens``. ``cu_seqlens`` has the bounds of its
    segments, ``position_resets`` the places where positions start again from 0;
    ``doc_ids`` and ``pieces`` name the segments in order.
    """

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, 256):
                part = rows.slice(at, 256)
                yield _matrix(part.column("sequence_id"), part.column("parts"), capacity)

    cut = tables.stored(packing.pieces(docs, tokenizer, capacity, with_ids=True), "id-pieces")
    plan_of = partial(best_fit_decreasing, capacity=capacity)
    placed = tables.stored(
        packing.dealt(cut.select("uid", "length"), plan_of).select("uid", "sequence_id", "offset"),
        "places",
    )
    # few places are sent to the ids, which then move once, to their sequences
    if placed.count() <= PLACES_TO_SEND:
        placed = F.broadcast(placed)
    segment = F.struct("offset", "doc_id", "piece", "ids")
    sequences = (
        cut.select("uid", "doc_id", "piece", "ids")
        .join(placed, "uid")
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(segment)).alias("parts"))
    )
    schema = ", ".join(f"{name} {kind}" for name, kind in _MATRIX.items())
    return sequences.mapInArrow(matrices, schema)


def position_ids(n_tokens: int, position_resets: list[int]) -> np.ndarray:
    """Positions of a sequence's tokens, counted from the last reset."""
    starts = np.array(position_resets)
    lengths = np.diff([*position_resets, n_tokens])
    return np.arange(n_tokens) - np.repeat(starts, lengths)
