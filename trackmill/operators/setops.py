"""Concatenation, overlap and reconciliation of issue sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat(batches: Sequence[DataFrame]) -> DataFrame:
    """All rows of all batches, repeated ones included, columns matched by name."""
    return reduce(lambda rows, batch: rows.unionByName(batch), batches)


def _sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    # A full outer join cannot split a hot key; counting per side combines map-side.
    both = left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return both.groupBy(key).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))


def reconcile(left: DataFrame, right: DataFrame, key: str = "issue_key") -> DataFrame:
    """Keys that the two stores do not hold equally often, with the count on each side."""
    return _sides(left, right, key).where(F.col("left_rows") != F.col("right_rows"))


def reconcile_summary(left: DataFrame, right: DataFrame, key: str = "issue_key") -> DataFrame:
    """One row: sizes of both stores, shared keys and keys on one side only."""
    in_left, in_right = F.col("left_rows") > 0, F.col("right_rows") > 0
    return _sides(left, right, key).agg(
        F.coalesce(F.sum("left_rows"), F.lit(0)).alias("left_count"),
        F.coalesce(F.sum("right_rows"), F.lit(0)).alias("right_count"),
        F.count_if(in_left & in_right).alias("shared_keys"),
        F.count_if(in_left & ~in_right).alias("only_left"),
        F.count_if(in_right & ~in_left).alias("only_right"),
    )


def overlap(left: DataFrame, right: DataFrame, key: str = "issue_key") -> DataFrame:
    """Distinct keys found on both sides."""
    return _sides(left, right, key).where(
        (F.col("left_rows") > 0) & (F.col("right_rows") > 0)
    ).select(key)
