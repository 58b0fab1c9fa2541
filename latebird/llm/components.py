"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebird.llm.common import staged

MAX_ROUNDS = 60


def _distinct(edges: DataFrame) -> DataFrame:
    """Each edge once; it is `moved` if any of its rows is."""
    return edges.groupBy("a", "b").agg(F.max("moved").alias("moved"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is moved to the node's smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _distinct(
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"), (F.col("m") != F.col("a")).alias("moved"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.max("moved").alias("moved"))
    joined = edges.select("a", "b").join(least.select("a", "m"), "a")
    return _distinct(
        joined.where("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"), F.lit(True).alias("moved"))
        .union(least.select("a", F.col("m").alias("b"), "moved"))
    )


def stars(edges: DataFrame) -> DataFrame:
    """`edges` (a long, b long; a > b) as (node, root): each node that is not the
    smallest of its component, with the smallest. Each round is written to the
    shared folder; the first that moves no edge is the last. A node is never
    gathered in one task: the joins are plain shuffle joins, which adaptive
    execution splits where a hub is hot, and both minima combine before the
    shuffle."""
    now = staged(edges.select("a", "b"), "edges")
    for _ in range(MAX_ROUNDS):
        now = staged(_small_star(_large_star(now)), "edges")
        if now.where("moved").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
