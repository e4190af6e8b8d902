"""Connected components by alternating large and small stars.

A large star hangs the greater neighbours of every node on its least neighbour, a
small star does so with the lesser ones; after about log(n) rounds every component
is one star around its least node. Each round is written and read back, so it
depends on files only. Nothing of the graph but two totals reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import tables


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    hung = both.join(least, "a").filter(F.col("b") > F.col("a"))
    return hung.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter(F.col("b") != F.col("least"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; ``edges`` has two long columns.

    The root is the least node of the component. Loops and repeated edges are
    allowed; no edges give no rows.
    """
    first, second = edges.columns
    now = tables.stored(
        edges.select(F.col(first).alias("a"), F.col(second).alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"))
        found = tuple(state.first())
        if found == seen or not found[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = found
        now = tables.stored(_small_star(_large_star(now)).distinct(), "stars")
