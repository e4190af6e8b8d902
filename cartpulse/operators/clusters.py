"""k-means over customers whose labels follow from the rows.

Values are standardised and held as whole numbers, so every sum is exact and neither the
order of rows nor their partitions change a centre. A pass sums their high and low bits as
longs; squares are summed once, in decimals, since all centres share their total. Seeds come from a table of cells, the
customers counted by sign and magnitude of each value: the fullest cell first, then the one
with the most customers times squared distance from the seeds so far. A pass over the rows
moves the centres of all numbers of clusters asked for at once. Clusters are numbered by
their centres, least values first.

The driver holds at most ``2 * MAGNITUDES - 1`` cells for each value combined, and the
centres. Columns without a spread count as 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSES = 20
TOLERANCE = 1e-4
MAGNITUDES = 17
# Values have four decimals; a standard deviation is so many whole numbers.
DECIMALS = 10_000
UNIT = 1 << 30
_LEAST_MAGNITUDE = 24  # bits of a value that count as none
_LOW_BITS = 20  # summed apart from the rest of a value, so that longs hold either sum
_WHOLE = "decimal(38,0)"

Centre = tuple[float, ...]


@dataclass(frozen=True)
class Clusters:
    columns: tuple[str, ...]
    shift: tuple[float, ...]
    scale: tuple[float, ...]
    centres: tuple[Centre, ...]
    cost: float  # squared distances from the centres, in standard deviations

    def label(self) -> Column:
        return nearest(points(self.columns, self.shift, self.scale), self.centres)


def _value(column: str) -> Column:
    filled = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    return F.rint(filled * float(DECIMALS)).cast("long")


def points(columns: Sequence[str], shift: Sequence[float], scale: Sequence[float]) -> list[Column]:
    return [
        F.rint((_value(column) - F.lit(by)) * F.lit(times)).cast("long")
        for column, by, times in zip(columns, shift, scale, strict=True)
    ]


def nearest(values: Sequence[Column], centres: Sequence[Centre]) -> Column:
    """Number of the nearest centre, of equally near ones the first."""
    distances = F.array(
        *[
            reduce(Column.__add__, [(v - F.lit(c)) * (v - F.lit(c)) for v, c in zip(values, centre, strict=True)])
            for centre in centres
        ]
    )
    return F.array_position(distances, F.array_min(distances)) - 1


def _standard(customers: DataFrame, columns: Sequence[str]) -> tuple[int, list[float], list[float]]:
    """(rows, mean and factor of each column), from exact sums."""
    values = customers.select(*[_value(c).cast(_WHOLE).alias(f"v{i}") for i, c in enumerate(columns)])
    sums = [F.sum(f"v{i}").alias(f"s{i}") for i in range(len(columns))]
    squares = [F.sum((F.col(f"v{i}") * F.col(f"v{i}")).cast(_WHOLE)).alias(f"q{i}") for i in range(len(columns))]
    row = values.agg(F.count("*").alias("n"), *sums, *squares).first()
    n, shift, scale = row["n"], [], []
    for i in range(len(columns)):
        s, q = int(row[f"s{i}"] or 0), int(row[f"q{i}"] or 0)
        variance = Fraction(n * q - s * s, n * (n - 1)) if n > 1 else Fraction(0)
        shift.append(float(Fraction(s, n)) if n else 0.0)
        scale.append(UNIT / float(variance) ** 0.5 if variance else 0.0)
    return n, shift, scale


def _cell(value: str) -> Column:
    magnitude = F.length(F.bin(F.shiftright(F.abs(F.col(value)), _LEAST_MAGNITUDE)))
    return F.signum(value).cast("int") * F.least(magnitude, F.lit(MAGNITUDES - 1))


def seeds(placed: DataFrame, names: Sequence[str], most: int) -> list[Centre]:
    """Means of up to ``most`` cells."""
    cells = placed.groupBy(*[_cell(name).alias(f"cell_{name}") for name in names]).agg(
        F.count("*").alias("n"), *[F.sum(F.col(name).cast(_WHOLE)).alias(name) for name in names]
    )
    found = sorted(
        (row["n"], tuple(float(Fraction(int(row[name]), row["n"])) for name in names))
        for row in cells.collect()
    )
    chosen: list[Centre] = []
    while found and len(chosen) < most:
        def weight(cell: tuple[int, Centre]) -> tuple[float, Centre]:
            n, mean = cell
            far = min((sum((a - b) ** 2 for a, b in zip(mean, c, strict=True)) for c in chosen), default=1.0)
            return n * far, mean

        best = max(found, key=weight)
        found.remove(best)
        chosen.append(best[1])
    return chosen


def _moved(placed: DataFrame, names: Sequence[str], centres: dict[int, list[Centre]]) -> dict:
    """(k, cluster) -> (rows, sums) with every row at its nearest centre.

    Tasks sum their rows by numpy, Spark adds up the tasks. As expressions the centres would
    make new code in every pass, which takes longer than the rows.
    """
    size = len(names)
    fields = ["n", *[f"{part}{i}" for part in "hl" for i in range(size)]]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {(k, c): [0] * len(fields) for k, own in centres.items() for c in range(len(own))}
        for batch in batches:
            whole = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(size)]
            values = [v.astype(np.float64) for v in whole]
            parts = [v >> _LOW_BITS for v in whole] + [v & ((1 << _LOW_BITS) - 1) for v in whole]
            for k, own in centres.items():
                distances = [
                    reduce(np.add, [(v - c) * (v - c) for v, c in zip(values, centre, strict=True)])
                    for centre in own
                ]
                at = np.argmin(distances, axis=0)
                found = [np.bincount(at, part, len(own)) for part in (None, *parts)]
                for c in range(len(own)):
                    totals[k, c] = [old + int(new[c]) for old, new in zip(totals[k, c], found, strict=True)]
        seen = [[*key, *sums] for key, sums in totals.items() if sums[0]]
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in zip(*seen, strict=True)],
                names=["k", "cluster", *fields],
            )

    schema = ", ".join(f"{name} long" for name in ("k", "cluster", *fields))
    by_task = placed.select(*names).mapInArrow(summed, schema)
    added = by_task.groupBy("k", "cluster").agg(*[F.sum(name).alias(name) for name in fields])
    return {
        (r["k"], r["cluster"]): (
            r["n"],
            [(r[f"h{i}"] << _LOW_BITS) + r[f"l{i}"] for i in range(size)],
        )
        for r in added.collect()
    }


def _squares(placed: DataFrame, names: Sequence[str]) -> int:
    whole = [F.col(name).cast(_WHOLE) for name in names]
    square = reduce(Column.__add__, [(v * v).cast(_WHOLE) for v in whole])
    return int(placed.agg(F.sum(square.cast(_WHOLE)).alias("q")).first()["q"])


def _cost(squares: int, sums: dict, k: int, centres: Sequence[Centre]) -> float:
    total = Fraction(squares)
    for cluster, centre in enumerate(centres):
        n, s = sums.get((k, cluster), (0, [0] * len(centre)))
        exact = [Fraction(c) for c in centre]
        total += sum(n * c * c - 2 * c * a for c, a in zip(exact, s, strict=True))
    return float(total / UNIT**2)


def fit(placed_from: DataFrame, columns: Sequence[str], ks: Iterable[int], kept) -> dict[int, Clusters]:
    """Clusters for every number in ``ks``; ``kept`` keeps rows while they are passed over.

    The rows are worked out once, whatever it takes to get them.
    """
    with kept(placed_from.select(*columns)) as rows:
        return _fit(rows, columns, ks)


def _fit(rows: DataFrame, columns: Sequence[str], ks: Iterable[int]) -> dict[int, Clusters]:
    n, shift, scale = _standard(rows, columns)
    names = [f"p{i}" for i in range(len(columns))]
    placed = rows.select(
        *[p.alias(name) for p, name in zip(points(columns, shift, scale), names, strict=True)]
    )
    wanted = sorted(set(ks))
    done: dict[int, Clusters] = {}
    if not n:
        return {k: Clusters(tuple(columns), tuple(shift), tuple(scale), ((0.0,) * len(names),), 0.0) for k in wanted}
    squares = _squares(placed, names)
    first = seeds(placed, names, max(wanted))
    moving = {k: first[:k] for k in wanted}
    for step in range(PASSES + 1):
        sums = _moved(placed, names, moving)
        for k, own in list(moving.items()):
            new = []
            for cluster, centre in enumerate(own):
                count, total = sums.get((k, cluster), (0, []))
                new.append(tuple(float(Fraction(a, count)) for a in total) if count else centre)
            shifted = max(
                sum((a - b) ** 2 for a, b in zip(old, now, strict=True)) ** 0.5
                for old, now in zip(own, new, strict=True)
            )
            if step == PASSES or shifted <= TOLERANCE * UNIT:
                ordered = tuple(sorted(own))
                done[k] = Clusters(tuple(columns), tuple(shift), tuple(scale), ordered, _cost(squares, sums, k, own))
                del moving[k]
            else:
                moving[k] = new
        if not moving:
            break
    return done
