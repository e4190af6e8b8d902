"""Random forests of regression trees, grown by passes over folded rows.

A forest tells values apart by at most ``BINS`` - 1 thresholds a feature. Rows with the same
place between the thresholds and the same label are one row with a weight, so what every pass
reads is bounded by the number of such cells, whatever the number of rows. All rows count:

* thresholds lie halfway between neighbouring values, between all of them if there are at
  most ``BINS``, else where the sorted rows are cut into ``BINS`` parts of one size;
* a tree draws every row a Poisson number of times with mean 1, so a row of weight n a
  Poisson number with mean n. Draws come from a hash of the row, so that they don't depend on
  where a row lies or how often a task is run;
* one pass a level works out the sums of all trees' nodes; the driver gets the best split of
  each node.

A split is the one that lowers the variance most, the first of equal ones; a node that none
lowers, or whose parts would have fewer than ``min_rows`` drawn rows, is a leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from copy import copy as shallow_copy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.sources import scratch

BINS = 32
# Folded rows that a task of a pass goes over, once all cores have some.
ROWS_PER_TASK = 2_000_000
# Folded rows that are worked on at once, few enough for a core's cache.
AT_ONCE = 1 << 16
KEY_BITS = 63
FOLDED = "key bigint, label double, n bigint, drawn bigint"
SPLIT = "tree int, node int, feature int, bin int, gain double, lc double, ls double, rc double, rs double"


def bits_of(thresholds: Sequence[Sequence[float]]) -> list[int]:
    """How many bits of a key the place between each feature's thresholds takes."""
    found = [len(own).bit_length() for own in thresholds]
    if sum(found) > KEY_BITS:
        raise ValueError(f"{len(found)} features do not fit a key of {KEY_BITS} bits")
    return found


def _place(value: Column, thresholds: Sequence[float], first: int = 0) -> Column:
    """How many thresholds are below the value."""
    if not thresholds:
        return F.lit(first).cast("long")
    middle = (len(thresholds) - 1) // 2
    below = _place(value, thresholds[:middle], first)
    above = _place(value, thresholds[middle + 1 :], first + middle + 1)
    return F.when(value <= F.lit(float(thresholds[middle])), below).otherwise(above)


def cell_key(values: Sequence[Column], thresholds: Sequence[Sequence[float]]) -> Column:
    """The places of all values in one number."""
    key, shift = F.lit(0).cast("long"), 0
    for value, own, bits in zip(values, thresholds, bits_of(thresholds), strict=True):
        key = key.bitwiseOR(F.shiftleft(_place(value, own), shift))
        shift += bits
    return key


def places(keys: np.ndarray, thresholds: Sequence[Sequence[float]]) -> np.ndarray:
    """(feature, row) places that the keys stand for."""
    found, shift = np.empty((len(thresholds), len(keys)), np.uint8), 0
    for feature, bits in enumerate(bits_of(thresholds)):
        found[feature] = (keys >> shift) & ((1 << bits) - 1)
        shift += bits
    return found


# ------------------------------------------------------------------ thresholds


def thresholds_of(rows: DataFrame, features: int) -> list[list[float]]:
    """The thresholds of each feature of the array ``values``, from how often every value is seen.

    The values are sorted over all tasks; only counts by task and the values on either side
    of a threshold reach the driver.
    """
    spark = rows.sparkSession
    seen = rows.select(F.posexplode("values")).groupBy("pos", "col").agg(F.count("*").alias("n"))
    folder = scratch.new_folder(spark, "forest-values")
    sorted_parts = seen.repartitionByRange("pos", "col").withColumn("part", F.spark_partition_id())
    sorted_parts.write.parquet(folder)
    seen = spark.read.schema("pos int, col double, n bigint, part int").parquet(folder)
    by_part = seen.groupBy("pos", "part").agg(
        F.sum("n").alias("n"), F.count("*").alias("values"), F.min("col").alias("least")
    )
    ends = sorted(by_part.collect(), key=lambda row: (row["pos"], row["least"]))
    begin, rows_of, values_of = [], [0] * features, [0] * features
    for i, row in enumerate(ends):
        after = ends[i + 1]["least"] if ends[i + 1 : i + 2] and ends[i + 1]["pos"] == row["pos"] else None
        begin.append((row["pos"], row["part"], rows_of[row["pos"]], after))
        rows_of[row["pos"]] += row["n"]
        values_of[row["pos"]] += row["values"]
    if not begin:
        raise ValueError("a forest needs rows to learn from")
    before = spark.createDataFrame(
        [(*row, rows_of[row[0]], values_of[row[0]] <= BINS) for row in begin],
        "pos int, part int, before bigint, after double, rows bigint, all boolean",
    )
    in_order = Window.partitionBy("pos", "part").orderBy("col")
    upto = F.col("before") + F.sum("n").over(in_order)
    counted = seen.join(F.broadcast(before), ["pos", "part"]).select(
        "pos",
        "col",
        "n",
        "rows",
        "all",
        upto.alias("upto"),
        F.coalesce(F.lead("col").over(in_order), "after").alias("next"),
    )
    part_of = [F.floor(upto * BINS / F.col("rows")) for upto in (F.col("upto") - F.col("n"), F.col("upto"))]
    cuts = counted.filter(F.col("next").isNotNull() & (F.col("all") | (part_of[0] < part_of[1])))
    found: list[list[float]] = [[] for _ in range(features)]
    for row in sorted(cuts.select("pos", "col", "next").collect()):
        middle = row["col"] + (row["next"] - row["col"]) / 2
        found[row["pos"]].append(middle if middle < row["next"] else row["col"])
    return found


# ------------------------------------------------------------------ folded rows


def folded(rows: DataFrame, thresholds: Sequence[Sequence[float]]) -> DataFrame:
    """(key, label, n) of the array ``values`` and ``label``; equal ones are one row."""
    values = [F.get("values", F.lit(i)) for i in range(len(thresholds))]
    keyed = rows.select(cell_key(values, thresholds).alias("key"), "label")
    return keyed.groupBy("key", "label").agg(F.count("*").alias("n"))


def _poisson_table(mean: int) -> np.ndarray:
    """The Poisson number that each of 65,536 equal parts of [0, 1) stands for."""
    most = int(mean + 12 * math.sqrt(mean) + 12)
    log_chance = [k * math.log(mean) - mean - math.lgamma(k + 1) for k in range(most)]
    upto = np.cumsum(np.exp(log_chance))
    return np.searchsorted(upto, (np.arange(65_536) + 0.5) / 65_536).astype(np.float64)


class Draws:
    """How often trees draw rows, from ``drawn``, a hash of each, in groups of four trees."""

    def __init__(self, seed: int) -> None:
        self.seed, self.tables = seed, {}

    def _hash(self, drawn: np.ndarray, number: int) -> np.ndarray:
        mixed = drawn + np.uint64((self.seed * 1_000_003 + number) * 0x9E3779B97F4A7C15 % 2**64)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return mixed ^ (mixed >> np.uint64(31))

    def of_trees(self, drawn: np.ndarray, n: np.ndarray, four: int) -> np.ndarray:
        """(4, rows) numbers for trees 4 * ``four`` and on; a weight is the sum of its powers of two."""
        found = np.zeros((4, len(n)))
        for power in range(int(n.max()).bit_length()):
            at = np.flatnonzero(n >> power & 1)
            if not len(at):
                continue
            if power not in self.tables:
                self.tables[power] = _poisson_table(1 << power)
            parts = self._hash(drawn[at], four * 64 + power).view(np.uint16).reshape(-1, 4)
            for tree in range(4):
                found[tree, at] += self.tables[power][parts[:, tree]]
        return found


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= AT_ONCE:
            yield _arrays(held)
            held, rows = [], 0
    if rows:
        yield _arrays(held)


def _arrays(held: list[pa.RecordBatch]) -> list[np.ndarray]:
    table = pa.Table.from_batches(held)
    return [table.column(i).to_numpy() for i in range(table.num_columns)]


# ------------------------------------------------------------------ trees


@dataclass
class Tree:
    """Nodes in the order they were made; a row goes left where its place is ``bin`` at most.

    A leaf is its own left node, which every row of it goes to.
    """

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def nodes(self, at: np.ndarray, steps: int) -> np.ndarray:
        """The node that each row, a column of places, is in after so many steps."""
        flat, width = at.ravel(), at.shape[1]
        rows, begins = np.arange(width), self.feature * width
        found = np.zeros(width, np.int64)
        for _ in range(steps):
            place = flat[begins[found] + rows]
            found = self.left[found] + (place > self.bin[found])
        return found


def _root() -> Tree:
    return Tree(
        np.zeros(1, np.int64), np.full(1, BINS, np.uint8), np.zeros(1, np.int64), np.zeros(1)
    )


def best_splits(sums: np.ndarray, begins: np.ndarray, min_rows: int) -> list[tuple]:
    """(node, feature, bin, gain, its sides' rows and sums) of ``sums`` (node, bin, [rows, sum]).

    ``begins`` are the bins that each feature's begin at, and their number last.
    """
    ends = np.repeat(begins[1:] - 1, np.diff(begins))
    upto = np.cumsum(sums, axis=1)
    before = np.repeat(np.concatenate([np.zeros_like(upto[:, :1]), upto[:, begins[1:-1] - 1]], axis=1), np.diff(begins), axis=1)
    left = upto - before
    right = upto[:, ends] - upto
    count, total = (left + right)[:, 0, 0], (left + right)[:, 0, 1]
    (lc, ls), (rc, rs) = np.moveaxis(left, 2, 0), np.moveaxis(right, 2, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ls * ls / lc + rs * rs / rc - (total * total / count)[:, None]
        least = 1e-9 * np.maximum(1, total * total / count)
    gain = np.where((lc >= max(1, min_rows)) & (rc >= max(1, min_rows)), gain, -1.0)
    best = gain.argmax(axis=1)
    feature = np.searchsorted(begins, best, side="right") - 1
    return [
        (
            node, int(feature[node]), int(best[node] - begins[feature[node]]), float(gain[node, best[node]]),
            *(float(side[node, best[node]]) for side in (lc, ls, rc, rs)),
        )
        for node in np.flatnonzero(gain[np.arange(len(best)), best] > least)
    ]


def _level(
    rows: DataFrame, trees: list[Tree], first: list[int], depth: int,
    thresholds: list[list[float]], min_rows: int, seed: int,
) -> list:
    """The best splits of the nodes from ``first`` on of each tree, all ``depth`` steps deep."""
    begins = np.concatenate([[0], np.cumsum([len(own) + 1 for own in thresholds])])
    growing = [i for i, tree in enumerate(trees) if len(tree.left) > first[i]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = Draws(seed)
        sums = {i: np.zeros((len(trees[i].left) - first[i], begins[-1], 2)) for i in growing}
        for key, label, n, drawn in _chunks(batches):
            at = places(key, thresholds)
            drawn = drawn.view(np.uint64)
            for four in sorted({i // 4 for i in growing}):
                drawn_by = draws.of_trees(drawn, n, four)
                for i in (i for i in growing if i // 4 == four):
                    node = trees[i].nodes(at, depth) - first[i]
                    some = np.flatnonzero((node >= 0) & (drawn_by[i % 4] > 0))
                    node, weight, own = node[some], drawn_by[i % 4][some], sums[i]
                    weighed = weight * label[some]
                    for feature, (begin, end) in enumerate(zip(begins, begins[1:], strict=False)):
                        place = node * (end - begin) + at[feature, some]
                        for kind, what in enumerate((weight, weighed)):
                            added = np.bincount(place, what, len(own) * (end - begin))
                            own[:, begin:end, kind] += added.reshape(len(own), -1)
        for i, own in sums.items():
            yield pa.record_batch(
                [pa.array([i], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["tree", "sums"]
            )

    def split(group: pa.Table) -> pa.Table:
        tree = group.column("tree")[0].as_py()
        whole = sum(np.frombuffer(one.as_py()) for one in group.column("sums"))
        found = best_splits(whole.reshape(-1, begins[-1], 2), begins, min_rows)
        names = [column.split()[0] for column in SPLIT.split(", ")]
        made = [(tree, first[tree] + node, *rest) for node, *rest in found]
        kinds = [pa.int32()] * 4 + [pa.float64()] * 5
        columns = [pa.array([row[i] for row in made], kind) for i, kind in enumerate(kinds)]
        return pa.table(columns, names)

    partial = rows.mapInArrow(run, "tree int, sums binary")
    return partial.groupBy("tree").applyInArrow(split, SPLIT).collect()


@dataclass
class Forest:
    """The estimator: ``fit`` reads a column of feature vectors and ``review_score``."""

    trees: int = 200
    depth: int = 8
    min_rows: int = 1
    seed: int = 42
    label: str = "review_score"

    def setNumTrees(self, trees: int) -> Forest:
        self.trees = trees
        return self

    def setMaxDepth(self, depth: int) -> Forest:
        self.depth = depth
        return self

    def copy(self) -> Forest:
        return shallow_copy(self)

    def fit(self, training: DataFrame) -> FittedForest:
        """The forest of all ``training`` rows, which are read twice."""
        rows = training.select(
            vector_to_array("features").alias("values"), F.col(self.label).cast("double").alias("label")
        ).filter("label is not null")
        first = rows.first()
        if first is None:
            raise ValueError("a forest needs rows to learn from")
        thresholds = thresholds_of(rows, len(first["values"]))
        few = folded(rows, thresholds).withColumn("drawn", F.xxhash64("key", "label"))
        few = few.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            cores = training.sparkSession.sparkContext.defaultParallelism
            tasks = cores * max(1, math.ceil(few.count() / (cores * ROWS_PER_TASK)))
            even = few.repartition(tasks, "key", "label").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                return self._grown(even, thresholds)
            finally:
                even.unpersist()
        finally:
            few.unpersist()

    def _grown(self, rows: DataFrame, thresholds: list[list[float]]) -> FittedForest:
        trees, first = [_root() for _ in range(self.trees)], [0] * self.trees
        gains = np.zeros((self.trees, len(thresholds)))
        mean = rows.agg(F.sum(F.col("label") * F.col("n")) / F.sum("n")).first()[0]
        for tree in trees:
            tree.value[0] = mean  # of a tree without a split
        for depth in range(self.depth):
            by_tree: dict[int, list] = {}
            for row in _level(rows, trees, first, depth, thresholds, self.min_rows, self.seed):
                by_tree.setdefault(row["tree"], []).append(row)
            first = [len(tree.left) for tree in trees]
            for i, found in by_tree.items():
                tree = trees[i]
                for row in sorted(found, key=lambda row: row["node"]):
                    gains[i, row["feature"]] += row["gain"]
                    tree.feature[row["node"]], tree.bin[row["node"]] = row["feature"], row["bin"]
                    tree.left[row["node"]] = at = len(tree.left)
                    tree.feature = np.append(tree.feature, [0, 0])
                    tree.bin = np.append(tree.bin, np.full(2, BINS, np.uint8))
                    tree.left = np.append(tree.left, [at, at + 1])
                    tree.value = np.append(tree.value, [row["ls"] / row["lc"], row["rs"] / row["rc"]])
            if not by_tree:
                break
        whole = gains.sum(axis=1, keepdims=True)
        shares = np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).sum(axis=0)
        shares = shares / shares.sum() if shares.sum() else shares
        return FittedForest(trees, thresholds, self.depth, DenseVector(shares))


@dataclass
class FittedForest:
    trees: list[Tree]
    thresholds: list[list[float]]
    depth: int
    featureImportances: DenseVector

    def scores(self, keys: np.ndarray) -> np.ndarray:
        """The mean of the trees' values, by cell."""
        found = np.zeros(len(keys))
        for begin in range(0, len(keys), AT_ONCE):
            at = places(keys[begin : begin + AT_ONCE], self.thresholds)
            for tree in self.trees:
                found[begin : begin + AT_ONCE] += tree.value[tree.nodes(at, self.depth)]
        return found / len(self.trees)

    def scored(self, rows: DataFrame, key: str, into: str) -> DataFrame:
        """Rows with the score of the cell in column ``key``; each row is scored.

        Cells are few and scoring takes long, so they are spread over more tasks than their
        size asks for.
        """
        rows = rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, key)
        at = rows.columns.index(key)
        schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scores = pa.array(self.scores(batch.column(at).to_numpy()))
                yield pa.record_batch([*batch.columns, scores], [*batch.schema.names, into])

        return rows.mapInArrow(run, f"{schema}, `{into}` double")

    def transform(self, rows: DataFrame, features: str = "features") -> DataFrame:
        """Rows with their ``prediction``; every different cell is scored once."""
        from cartpulse.operators import models

        valued = rows.withColumn("_values", vector_to_array(features))
        return models.cell_scores(valued, self, {"_values": "prediction"}).drop("_values")

    def errors(self, rows: DataFrame, features: str = "features", label: str = "review_score") -> tuple[float, float]:
        """(mean squared error, population variance of the label) over rows, NaN without any."""
        read = rows.select(
            vector_to_array(features).alias("values"), F.col(label).cast("double").alias("label")
        )
        off = F.col("label") - F.col("score")
        n, of_label = F.sum("n"), F.col("n") * F.col("label")
        found = self.scored(folded(read, self.thresholds), "key", "score").agg(
            F.sum(F.col("n") * off * off).alias("off"),
            n.alias("n"),
            F.sum(of_label).alias("sum"),
            F.sum(of_label * F.col("label")).alias("squares"),
        ).first()
        if not found["n"]:
            return math.nan, math.nan
        mean = found["sum"] / found["n"]
        return found["off"] / found["n"], found["squares"] / found["n"] - mean * mean
