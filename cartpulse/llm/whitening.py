"""Embedding whitening from a bit-sliced scatter matrix.

An entry ``c`` becomes the integer ``x = floor(64 c) + 1,000,000``. Shifted by its
dimension's least value, an integer is a few bits, and the bits of one place over many
rows are packed into words: a dimension's bit planes. The sum of products of two
dimensions is the sum over pairs of their planes of ``2 ** (a + b)`` times the ones that
both planes have, so words are ANDed and their ones counted, and no product is rounded.
Tasks hand on one number for each pair of dimensions; Spark adds these up as decimals.

``n * sum(x y) - sum(x) sum(y)`` is then the covariance times ``n ** 2``, still a whole
number. Only its quotient is rounded, once, before the eigenvectors are taken. What the
driver gets and holds grows with the square of the dimension, not with the rows.

Defined cases: a vector that is null, or has a null, infinite or NaN entry, or one of
``2 ** 34`` or more in size, is dropped, as is one of another length than most have (of
lengths alike frequent, the greater counts) and an empty one. Components whose variance
is 0, up to rounding, cannot be whitened and are not returned, so equal vectors, a single
one and an empty table give no rows. A deviation beyond 64 bits is null. Repeated rows
and equal ids are rows of their own, a null ``vec_id`` stays null, other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
OFFSET = 1_000_000
LARGEST = 2.0**34
COMPONENTS = 32
ROWS_PER_CHUNK = 8_192
LEAST_VARIANCE = 1e-12  # of the greatest component's
_WHOLE = pa.decimal128(38, 0)


def integers(vectors: pa.ListArray, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the sound vectors, their integers, one row each)."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(lengths == dimension)
    entries = vectors.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
    entries = entries.astype(np.float64).reshape(-1, dimension)
    with np.errstate(invalid="ignore"):
        sound = (np.abs(entries) < LARGEST).all(axis=1)  # false for NaN
    return places[sound], np.floor(SCALE * entries[sound]).astype(np.int64) + OFFSET


def bit_planes(shifted: np.ndarray, widths: list[int]) -> np.ndarray:
    """One row of 64-bit words for each dimension's bit, bits of a dimension from the lowest."""
    rows = shifted.shape[0]
    padded = np.zeros((sum(widths), -(-rows // 64) * 64), dtype=np.uint8)
    at = 0
    for column, width in zip(shifted.T, widths, strict=True):
        for bit in range(width):
            padded[at, :rows] = column >> bit & 1
            at += 1
    return np.packbits(padded, axis=1).view(np.uint64)


def scatter(shifted: np.ndarray, widths: list[int]) -> np.ndarray:
    """Sums of products of any two columns of non-negative integers, exact Python integers."""
    planes = bit_planes(shifted, widths)
    # a product fits a long unless rows and bits are many
    fits = 2 * max(widths, default=0) + shifted.shape[0].bit_length() < 63
    kind = np.int64 if fits else object
    weights = np.array([1 << bit for width in widths for bit in range(width)], dtype=kind)
    owners = np.repeat(np.arange(len(widths)), widths)
    starts = np.cumsum([0, *widths])
    found = np.zeros((len(widths), len(widths)), dtype=kind)
    for plane, (owner, weight) in enumerate(zip(owners, weights, strict=True)):
        first = starts[owner]  # dimensions before the owner have met it already
        ones = np.bitwise_count(planes[first:] & planes[plane]).sum(axis=1, dtype=np.int64)
        products = ones.astype(kind) * weights[first:] * weight
        at = np.unique(owners[first:], return_index=True)
        found[owner, at[0]] += np.add.reduceat(products, at[1])
    return np.triu(found).astype(object)


@dataclass
class Whitening:
    n: int
    sums: list[int]
    variances: np.ndarray  # of the components returned, falling
    components: np.ndarray  # one column each
    trace: float
    span: int  # most that two integers of one dimension differ by

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        fits = self.n * max(self.span, 1) < 1 << 62 and self.n * (OFFSET + 2**41) < 1 << 62
        kind = np.int64 if fits else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        centred = (deviations / self.n).astype(np.float64)
        return centred @ self.components / np.sqrt(self.variances)

    def lengths(self, deviations: np.ndarray) -> list[int | None]:
        """Sums of squares; None beyond a long."""
        if self.dimension * (self.n * self.span) ** 2 >= 1 << 63:
            deviations = deviations.astype(object)
        found = (deviations * deviations).sum(axis=1).tolist()
        return [one if one < 1 << 63 else None for one in found]


def _vectors(embeddings: DataFrame, vector: str) -> DataFrame:
    return embeddings.select(F.col(vector).cast("array<double>").alias("vector"))


def _usual_length(vectors: DataFrame) -> int:
    usable = vectors.filter(F.expr(f"size(vector) > 0 and forall(vector, c -> abs(c) < {LARGEST})"))
    counts = usable.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    row = counts.orderBy(F.desc("n"), F.desc("length")).first()
    return row["length"] if row else 0


def _chunks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    for rows in batches:
        for at in range(0, rows.num_rows, ROWS_PER_CHUNK):
            _, x = integers(rows.column("vector").slice(at, ROWS_PER_CHUNK), dimension)
            if len(x):
                yield x


def _bounds(vectors: DataFrame, dimension: int) -> tuple[int, list[int], list[int], list[int]]:
    """(rows, and of every dimension the sum, the least and the greatest integer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, dtype=object)
        least = np.full(dimension, np.iinfo(np.int64).max)
        greatest = np.full(dimension, np.iinfo(np.int64).min)
        for x in _chunks(batches, dimension):
            n += len(x)
            total += x.sum(axis=0)
            least = np.minimum(least, x.min(axis=0))
            greatest = np.maximum(greatest, x.max(axis=0))
        if n:
            yield pa.record_batch(
                [
                    pa.array(range(dimension), pa.int32()),
                    pa.array([n] * dimension, pa.int64()),
                    pa.array(total.tolist(), _WHOLE),
                    pa.array(least),
                    pa.array(greatest),
                ],
                ["i", "n", "s", "least", "greatest"],
            )

    found = vectors.mapInArrow(run, "i int, n bigint, s decimal(38,0), least bigint, greatest bigint")
    rows = (
        found.groupBy("i")
        .agg(F.sum("n"), F.sum("s"), F.min("least"), F.max("greatest"))
        .orderBy("i")
        .collect()
    )
    if not rows:
        return 0, [], [], []
    return rows[0][1], [int(r[2]) for r in rows], [r[3] for r in rows], [r[4] for r in rows]


def _scatter(vectors: DataFrame, least: list[int], widths: list[int]) -> dict[tuple[int, int], int]:
    dimension, above = len(widths), np.triu_indices(len(widths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension), dtype=object)
        for x in _chunks(batches, dimension):
            total += scatter(x - np.array(least), widths)
        yield pa.record_batch(
            [
                pa.array(above[0], pa.int32()),
                pa.array(above[1], pa.int32()),
                pa.array(total[above].tolist(), _WHOLE),
            ],
            ["i", "j", "q"],
        )

    found = vectors.mapInArrow(run, "i int, j int, q decimal(38,0)").groupBy("i", "j")
    return {(r["i"], r["j"]): int(r["q"]) for r in found.agg(F.sum("q").alias("q")).collect()}


def fit(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Components of all sound vectors; none if there is nothing that varies."""
    vectors = _vectors(embeddings, vector)
    dimension = _usual_length(vectors)
    n, sums, least, greatest = _bounds(vectors, dimension) if dimension else (0, [], [], [])
    if not n:
        return Whitening(0, [], np.empty(0), np.empty((0, 0)), 0.0, 0)
    spans = [hi - lo for lo, hi in zip(least, greatest, strict=True)]
    products = _scatter(vectors, least, [span.bit_length() for span in spans])
    shifted = [s - n * lo for s, lo in zip(sums, least, strict=True)]
    covariance = np.zeros((dimension, dimension))
    trace = 0
    for (i, j), product in products.items():
        centred = n * product - shifted[i] * shifted[j]  # whole number, n ** 2 times the covariance
        covariance[i, j] = covariance[j, i] = centred / n**2
        trace += centred * (i == j)
    variances, directions = np.linalg.eigh(covariance)
    falling = np.argsort(-variances, kind="stable")[:components]
    falling = falling[variances[falling] > max(variances.max(), 0) * LEAST_VARIANCE]
    return Whitening(n, sums, variances[falling], directions[:, falling], trace / n**2, max(spans))


def _per_chunk(
    model: Whitening, emit: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], pa.RecordBatch]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, ROWS_PER_CHUNK):
                part = rows.slice(at, ROWS_PER_CHUNK)
                places, x = integers(part.column("vector"), model.dimension)
                if len(x):
                    yield emit(part, places, x)

    return run


def identity_error(embeddings: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.variances)

    def partial(part: pa.RecordBatch, places: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        z = model.whitened(model.deviations(x))
        sums = np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])
        return pa.record_batch([pa.array(np.arange(len(sums))), pa.array(sums)], ["place", "total"])

    found = _vectors(embeddings, vector).mapInArrow(
        _per_chunk(model, partial), "place bigint, total double"
    )
    rows = found.groupBy("place").agg(F.sum("total")).orderBy("place").collect()
    totals = np.array([row[1] for row in rows]) / model.n
    means, products = totals[:k], totals[k:].reshape(k, k)
    return float(np.abs(products - np.outer(means, means) - np.eye(k)).max())


WHITENED = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double,"
    " explained double, identity_error double"
)


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per sound vector and component."""
    model = fit(embeddings, vector, components)
    k = len(model.variances)
    if not k:
        return embeddings.sparkSession.createDataFrame([], WHITENED)
    error = identity_error(embeddings, model, vector)
    explained = model.variances / model.trace

    def emit(part: pa.RecordBatch, places: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        deviations, m = model.deviations(x), len(x)
        columns = {
            "vec_id": part.column("vec_id").take(pa.array(np.repeat(places, k))),
            "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
            "n": pa.array(np.full(m * k, model.n, dtype=np.int64)),
            "deviation": pa.array(model.lengths(deviations), pa.int64()).take(
                pa.array(np.repeat(np.arange(m), k))
            ),
            "whitened": pa.array(model.whitened(deviations).ravel()),
            "explained": pa.array(np.tile(explained, m)),
            "identity_error": pa.array(np.full(m * k, error)),
        }
        return pa.record_batch(list(columns.values()), list(columns))

    source = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return source.mapInArrow(_per_chunk(model, emit), WHITENED)
