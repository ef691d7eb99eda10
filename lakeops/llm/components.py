"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.scratch import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its neighbours below are linked to the smallest of them.  Edges run from the larger to the smaller node."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component for every node of the edges (a, b) but the roots themselves.

    The number of rounds grows with the logarithm of the longest path.  Each step writes its edges to the shared folder; a hub's rows
    meet only in joins, which adaptive execution splits, and in minima, which are formed before the shuffle.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _mark(edges)
    while before[0]:
        edges = stored(_small_star(stored(_large_star(edges))))
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
