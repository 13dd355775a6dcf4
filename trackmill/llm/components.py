"""Connected components of links, by alternating large and small stars.

Each round hooks every node to the least node it knows; a cluster of any shape is a star
around its least node after a number of rounds that grows with the logarithm of its size.
Nodes meet in grouped minima, which combine map-side, and in joins with one row per node on
one side.  That side is written first: a join of two plain exchanges is one that adaptive
execution can split, where a node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.session import durable


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = durable(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges as large stars leave them: ``a`` above ``b``."""
    least = durable(edges.groupBy("a").agg(F.min("b").alias("m")))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(found)


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with a link.

    Links count in both directions and may repeat; links of a node to itself and absent ends
    say nothing.  Fails rather than return components that are not finished.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(edges)
    for _ in range(rounds):
        edges = durable(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
    raise RuntimeError("components are not finished")
