"""Connected components of a graph given as a table of edges.

Alternating large and small stars: every round hooks the neighbours of a node
onto the smallest of them.  A node's minimum is found by a partially
aggregated ``min``, so a node with a third of all edges is no bottleneck; the
minima are stored before they are joined, so that adaptive execution can split
a hot node's edges.  The number of rounds grows with the logarithm of the
longest chain.  Nothing is collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toneflow.llm.tables import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = stored(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "minima")
    out = both.filter("b > a").join(least, F.col("a") == F.col("u"))
    return out.select(F.col("b").alias("a"), F.least("m", "u").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "minima")
    out = edges.join(least, F.col("a") == F.col("u"))
    return out.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; the root is the smallest node.

    ``edges`` has two comparable columns ``a`` and ``b``; loops, repeats and
    null ends are ignored; no edges give an empty table.
    """
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), "edges")
    before, now = None, _state(edges)
    while now != before:
        edges = stored(_small_star(stored(_large_star(edges).distinct(), "edges")).distinct(), "edges")
        before, now = now, _state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct())
