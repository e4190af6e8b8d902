"""Periodic runs of words by a dictionary of basic factors.

The basic factors of a text are its stretches of ``2 ** k`` words; equal ones get equal
names, those of one length from the names of its two halves. A run of smallest period
``q`` has, for the power with ``2 ** (k-1) < q <= 2 ** k``, a factor whose next occurrence
is ``q`` words on, for a shorter distance would be a shorter period. So of each factor the
next occurrence within twice its length is looked up, and three occurrences at equal
distances, an arithmetic progression, propose their distance as a period. Places that
follow each other with one proposal belong to one run, which reaches from the first to
the end of the last one's progression. A run of four or more periods holds such a
progression, so none is missed, and each period is proposed by one length only.

Factors that occur once cannot recur when they are longer and are left out of the
further lengths, which ends soon in texts that don't repeat themselves.

Each text is worked on by itself, in memory of a few numbers a word.

Defined cases: words are runs of bytes without white space (space, \\t \\n \\v \\f \\r);
a null or empty text has no words, no runs and the digest of the empty string twice;
repeated rows and equal ids are looked at each; an empty table gives no rows; a null
``doc_id`` stays null and its text is not changed by ``with_planted_period``. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 6
LEAST_PERIODS = 4


def word_names(words: list[bytes]) -> np.ndarray:
    """Numbers that are equal for equal words."""
    names: dict[bytes, int] = {}
    given = (names.setdefault(word, len(names)) for word in words)
    return np.fromiter(given, np.int64, len(words))


def _recurring(places: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, names from 0 without gaps, next place of the same name or -1), only of names met twice."""
    order = np.argsort(names, kind="stable")  # places stay in order within a name
    sorted_names = names[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = sorted_names[1:] != sorted_names[:-1]
    again = ~new
    again[:-1] |= ~new[1:]
    following = np.full(len(order), -1, dtype=np.int64)
    same = np.flatnonzero(~new)
    following[same - 1] = places[order[same]]
    renamed = np.empty(len(order), dtype=np.int64)
    renamed[order] = np.cumsum(new) - 1
    next_place = np.empty(len(order), dtype=np.int64)
    next_place[order] = following
    kept = np.empty(len(order), dtype=bool)
    kept[order] = again
    return places[kept], renamed[kept], next_place[kept]


def runs(names: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period."""
    n = len(names)
    found = []
    places, named, following = _recurring(np.arange(n), names)
    length = 1
    while len(places) and LEAST_PERIODS * (length // 2 + 1) <= n:
        # distance to the next occurrence, by place; 0 where it is none or too far
        step = np.zeros(n + 1, dtype=np.int64)
        distance = following - places
        near = (following >= 0) & (distance <= 2 * length)
        step[places[near]] = distance[near]
        at = places[near]
        period = step[at]
        third = step[at + period] == period  # an arithmetic progression of three
        own = (period > length // 2) & (period <= length)  # other lengths propose the rest
        at, period = at[third & own], period[third & own]
        if len(at):
            breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(period) != 0)) + 1
            firsts = np.concatenate([[0], breaks])
            lasts = np.concatenate([breaks, [len(at)]]) - 1
            start, q = at[firsts], period[firsts]
            end = at[lasts] + 2 * q + length
            found.append(np.column_stack([start, end - start, q]))
        # factors of twice the length: both halves recur
        name_at = np.full(n + 1, -1, dtype=np.int64)
        name_at[places] = named
        halves = places[places + length < n]
        second = name_at[halves + length]
        both = second >= 0
        halves, second = halves[both], second[both]
        longer = name_at[halves] * (named.max() + 1) + second
        places, named, following = _recurring(halves, longer)
        length *= 2
    if not found:
        return np.empty((0, 3), dtype=np.int64)
    proposed = np.unique(np.concatenate(found), axis=0)  # by start, then length
    long_enough = proposed[:, 1] >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * proposed[:, 2])
    proposed = proposed[long_enough]
    return proposed[np.lexsort((proposed[:, 2], proposed[:, 0]))]


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Which words stay when every run keeps its first period only."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edges[:n]) == 0


def most_periodic(found: np.ndarray) -> tuple[int, int, int] | None:
    """The run of greatest length / period; of equals the first, then the one of smallest period."""
    best = None
    for start, length, period in found.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def with_planted_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """In one of ten documents, by CRC-32 of the id, the words from some place on become periodic."""
    if doc_id is None or not words:
        return words
    crc = zlib.crc32(str(doc_id).encode())
    if crc % 10:
        return words
    g, n = crc // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


RUN_COLUMNS = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint,"
    " runs_sha256 string, collapsed_sha256 string, collapsed string"
)


def _summary(words: list[bytes], with_text: bool) -> tuple:
    found = runs(word_names(words))
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in found.tolist())
    if len(found):
        stay = kept_words(len(words), found)
        words = [words[i] for i in np.flatnonzero(stay)]
    collapsed = b" ".join(words)
    best = most_periodic(found)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (
        len(found),
        *top,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(collapsed).hexdigest(),
        collapsed.decode(errors="replace") if with_text else None,
    )


def periodic_runs(
    docs: DataFrame,
    prepare: Callable[[list[bytes], int | None], list[bytes]] | None = None,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: its runs, the most periodic one, and the text without repeated periods.

    ``prepare`` changes a document's words first. ``collapsed`` is null unless ``with_text``.
    """
    kinds = [pa.int64()] * 5 + [pa.string()] * 3
    names = [column.split()[0] for column in RUN_COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, 512):
                part = rows.slice(at, 512)
                found = []
                for doc_id, text in zip(
                    part.column("doc_id").to_pylist(), part.column("text"), strict=True
                ):
                    words = (text.as_py() or b"").split()
                    found.append(_summary(prepare(words, doc_id) if prepare else words, with_text))
                columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.record_batch([part.column("doc_id"), *columns], ["doc_id", *names])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary"))
    return source.mapInArrow(run, f"doc_id bigint, {RUN_COLUMNS}")


def planted_runs(docs: DataFrame) -> DataFrame:
    """The runs of all documents after ``with_planted_period``, with digests for the texts."""
    return periodic_runs(docs, with_planted_period, with_text=False).drop("collapsed")
