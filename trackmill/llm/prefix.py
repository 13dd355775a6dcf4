"""Running sums over a whole table in a given order, without one task that holds it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmill.session import durable


def running_sums(df: DataFrame, order: Sequence[str | Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with, for each ``name: column`` of ``sums``, the sum of the column over all rows
    up to and including this one.

    Rows are range-partitioned by the order and written once, so that their partitions
    stay what they are; a row's sum is that of the partitions before plus that inside its
    own.  Only the sums of partitions, one row each, meet in one task.
    """
    placed = durable(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy("_part").agg(*[F.sum(column).alias(f"_of_{name}") for name, column in sums.items()])
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "_part",
        *[F.coalesce(F.sum(f"_of_{name}").over(before), F.lit(0)).alias(f"_before_{name}") for name in sums],
    )
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    # One row per partition: its size is the partition count, whatever the table holds.
    placed = placed.join(F.broadcast(starts), "_part")
    return placed.select(
        *df.columns,
        *[(F.col(f"_before_{name}") + F.sum(column).over(inside)).alias(name) for name, column in sums.items()],
    )
