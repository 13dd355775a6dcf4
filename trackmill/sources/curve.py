"""Files laid out along a space-filling curve, so that filters on any of several columns skip files.

A column's values become ranks: what share of the rows lies below.  The ranks' bits are interleaved,
highest first, and rows are sorted by the resulting number: neighbours on the curve are near in all
columns, and every file spans a small part of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BITS = 5
ACCURACY = 10_000


def ranked_values(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """The values of a column of few values with their rank below ``2 ** bits``, by the share of
    the rows before the middle of each: one row per value."""
    counted = df.groupBy(column).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(W.orderBy(F.col(column).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1))
    middle = F.coalesce(upto, F.lit(0)) + F.col("_n") / 2
    share = middle / F.sum("_n").over(W.partitionBy())
    return counted.select(column, F.least(F.floor(share * (1 << bits)), F.lit((1 << bits) - 1)).alias("_rank"))


def cut_points(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Values that cut each column of numbers or times into ``2 ** bits`` parts of about the same size,
    from one pass; a few numbers for each column come to the driver."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[
        F.percentile_approx(_number(df, name), shares, ACCURACY).alias(f"_{i}") for i, name in enumerate(columns)
    ]).first()
    return {name: list(dict.fromkeys(found[f"_{i}"] or [])) for i, name in enumerate(columns)}


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.simpleString()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column)


def _at_most(number: Column):
    return lambda cut: cut <= number


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """One number from the bits of several ranks, the highest bits of all first."""
    found = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            found = F.shiftleft(found, 1).bitwiseOR(one)
    return found


def with_curve(df: DataFrame, few: Sequence[str], many: Sequence[str], bits: int = BITS, name: str = "_curve") -> DataFrame:
    """``df`` with each row's place on the curve over the columns ``few``, whose values are few
    enough for one task to rank, and ``many``, numbers or times of any number of values.  Absent
    values rank lowest."""
    cuts = cut_points(df, many, bits)
    ranks, joined = [], df
    for i, column in enumerate(few):
        values = ranked_values(df, column, bits).select(F.col(column).alias(f"_v{i}"), F.col("_rank").alias(f"_r{i}"))
        joined = joined.join(values, F.col(column).eqNullSafe(F.col(f"_v{i}")))
        ranks.append(F.col(f"_r{i}"))
    for column in many:
        points = F.array(*[F.lit(value) for value in cuts[column]]) if cuts[column] else F.array().cast("array<long>")
        number = _number(df, column)
        below = F.size(F.filter(points, _at_most(_number(df, column))))
        ranks.append(F.when(F.col(column).isNull(), F.lit(0)).otherwise(below))
    return joined.withColumn(name, interleaved(ranks, bits)).select(*df.columns, name)


def compact_on_curve(
    issues: DataFrame, path: str, few: Sequence[str] = ("project_key",), many: Sequence[str] = ("created", "updated"),
    key: str = "id", partitions: int | None = None, max_records: int = 5_000_000, bits: int = BITS,
) -> DataFrame:
    """Rewrite to ``path`` along the curve, in ``partitions`` files or as many as the session has shuffle
    partitions; the unique key splits places that hold very many rows."""
    order = [F.col("_curve"), F.col(key)]
    placed = with_curve(issues, few, many, bits)
    dealt = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    laid_out = dealt.sortWithinPartitions(*order).drop("_curve")
    laid_out.write.mode("overwrite").option("maxRecordsPerFile", max_records).parquet(path)
    return issues.sparkSession.read.parquet(path)
