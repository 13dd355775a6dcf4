"""Scans in a whole-table order: sums so far and the row before, without one task that holds
the table and without a window per key.

Rows are range-partitioned by the order and written once, so that their partitions stay what
they are.  Inside a partition a window does the work; between partitions one row each is
carried, and only these rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmill.session import durable

PART = "_part"


def ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` dealt into ranges of ``order``, written, with the number of each row's range.
    Rows that agree in the whole order meet in one range, so let it end in something unique."""
    return durable(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def inside(order: Sequence[Column]):
    """Rows of one range in order."""
    return W.partitionBy(PART).orderBy(*order)


def sums_before(placed: DataFrame, **sums: Column) -> DataFrame:
    """For each range, what the ranges before it sum up to: one row per range."""
    totals = placed.groupBy(PART).agg(*[F.sum(column).alias(name) for name, column in sums.items()])
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(PART, *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in sums])


def with_previous(
    df: DataFrame, order: Sequence[Column], columns: Sequence[str], group: Sequence[str]
) -> DataFrame:
    """``df`` with ``previous``, the ``columns`` of the row before in the whole table's order, null
    where that row has other values of ``group`` (absent values are equal) or there is none.

    The last row of a range is carried to the next one; however many rows a group has, it
    needs no task of its own.
    """
    seen = F.struct(*dict.fromkeys([*columns, *group]))
    run = inside(order)
    looked = ranged(df, order).withColumns({
        "_before": F.lag(seen).over(run), "_first": F.row_number().over(run) == 1,
        "_last": F.lead(F.lit(1)).over(run).isNull(),
    })
    tails = looked.where("_last").select(PART, seen.alias("_tail"))
    # One row per range: small enough for one window task and to broadcast.
    carried = tails.select(PART, F.lag("_tail").over(W.orderBy(PART)).alias("_carried"))
    joined = looked.join(F.broadcast(carried), PART)
    before = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before"))
    joined = joined.withColumn("_before", before)
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_before.{name}")) for name in group])
    previous = F.when(F.col("_before").isNotNull() & same, F.struct(*[F.col(f"_before.{name}") for name in columns]))
    return joined.select(*df.columns, previous.alias("previous"))
