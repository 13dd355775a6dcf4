"""Reconciling two stores by digests: only the ranges that differ are compared row by row.

Keys are dealt into ranges of their hash.  A range's digest is the sum of its rows' hashes beside
their number, so it does not depend on their order, and combines inside tasks before anything
is moved.  Digests of ranges sum up to those of wider ranges: a tree that is descended from the
root, where only the children of ranges that differ are looked at.  A store can keep its digests, and
its rows by range, and then gives away its equal ranges without reading them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.operators.setops import reconcile
from trackmill.session import durable
from trackmill.sources.tables import save_table

RANGE = "key_range"
# A store has 2 ** RANGE_BITS ranges; a step of the tree takes STEP_BITS of them.
RANGE_BITS = 8
STEP_BITS = 4
# Differing ranges may be named in a filter, since there are never more than these.
MOST_BITS = 12


def key_range(key: str, bits: int = RANGE_BITS) -> Column:
    """The range of a key: the upper bits of its hash.  Absent keys share a range."""
    if not 1 <= bits <= MOST_BITS:
        raise ValueError(f"a store has 2 to {1 << MOST_BITS} ranges")
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int")


def save_by_range(df: DataFrame, path: str, key: str, bits: int = RANGE_BITS) -> int:
    """Write a store with its rows by range, so that a reader of few ranges reads few folders."""
    return save_table(df.withColumn(RANGE, key_range(key, bits)).hint("rebalance", RANGE), path, [RANGE])


def range_digests(
    df: DataFrame, key: str = "issue_key", columns: Sequence[str] = (), bits: int = RANGE_BITS
) -> DataFrame:
    """``node``, rows ``n`` and ``digest`` of every range that has any: one row per range.

    The key alone is compared, or the given ``columns`` (a version, say) beside it."""
    hashed = F.xxhash64(*[F.col(name) for name in [key, *columns]]).cast("decimal(38,0)")
    node = F.col(RANGE) if RANGE in df.columns else key_range(key, bits)
    return df.groupBy(node.alias("node")).agg(F.count("*").alias("n"), F.sum(hashed).alias("digest"))


def wider(digests: DataFrame, step: int = STEP_BITS) -> DataFrame:
    """The digests one level up the tree."""
    return digests.groupBy(F.shiftright("node", step).alias("node")).agg(
        F.sum("n").alias("n"), F.sum("digest").alias("digest")
    )


def differing_ranges(left: DataFrame, right: DataFrame, bits: int = RANGE_BITS, step: int = STEP_BITS) -> DataFrame:
    """``node`` of the ranges whose digests differ, found from the root of both trees down."""
    levels = [(durable(left), durable(right))]
    height = -(-bits // step)
    for _ in range(height):
        below = levels[-1]
        levels.append((wider(below[0], step), wider(below[1], step)))
    found = None
    for mine, theirs in reversed(levels):
        if found is not None:
            parents = found.select(F.col("node").alias("_parent"))
            mine, theirs = (
                side.join(parents, F.shiftright("node", step) == F.col("_parent"), "left_semi") for side in (mine, theirs)
            )
        # Sides are counted against each other as in reconcile; a range without rows has no digest.
        zero = F.lit(0).cast("decimal(38,0)")
        both = mine.select("node", "n", "digest").union(theirs.select("node", -F.col("n"), -F.col("digest")))
        found = both.groupBy("node").agg(F.sum("n").alias("n"), F.sum("digest").alias("digest")).where(
            (F.col("n") != 0) | (F.col("digest") != zero)
        )
    return durable(found.select("node"))


def _of_ranges(df: DataFrame, key: str, nodes: list[int], bits: int) -> DataFrame:
    node = F.col(RANGE) if RANGE in df.columns else key_range(key, bits)
    return df.where(node.isin(nodes)) if nodes else df.limit(0)


def reconcile_by_digest(
    left: DataFrame, right: DataFrame, key: str = "issue_key", bits: int = RANGE_BITS,
    left_digests: DataFrame | None = None, right_digests: DataFrame | None = None,
) -> DataFrame:
    """What ``reconcile`` finds: keys that the stores do not hold equally often, with their rows on
    each side.

    The ranges that differ, at most ``2 ** MOST_BITS`` numbers, come to the driver and go into the
    scan's filter: a store saved by range is read only there.  Digests that a store has kept are
    taken as they are.
    """
    mine = left_digests if left_digests is not None else range_digests(left, key, bits=bits)
    theirs = right_digests if right_digests is not None else range_digests(right, key, bits=bits)
    nodes = [row["node"] for row in differing_ranges(mine, theirs, bits).collect()]
    return reconcile(_of_ranges(left, key, nodes, bits), _of_ranges(right, key, nodes, bits), key)
