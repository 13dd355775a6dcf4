"""Deep pages of a stored order: a sorted table beside how many rows stand before each of its files.

A page then reads the files it lies in, wherever it is, and sorts only these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmill.sources.tables import save_table

PLACE = "_place"


def save_sorted(df: DataFrame, order: Sequence[Column], path: str, files: int | None = None) -> SortedFiles:
    """Write ``df`` in ``files`` ranges of ``order``, or as many as the session has shuffle partitions, and
    the offsets of its files.  Let the order end in something unique."""
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    placed = dealt.sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id())
    placed.write.mode("overwrite").parquet(f"{path}/rows")
    spark = df.sparkSession
    # A range's rows are numbered from the range's number times 2 ** 33 on, which also sorts the files.
    rows = spark.read.parquet(f"{path}/rows").select(F.col("_metadata.file_path").alias("file"), PLACE)
    counted = rows.groupBy("file").agg(F.min(PLACE).alias("first"), F.count("*").alias("rows"))
    before = W.orderBy("first").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    save_table(counted.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).coalesce(1), f"{path}/offsets")
    return SortedFiles(spark, path, list(df.columns))


class SortedFiles:
    def __init__(self, spark: SparkSession, path: str, columns: list[str]) -> None:
        self.spark, self.path, self.columns = spark, path, columns

    def files_of(self, offset: int, limit: int | None) -> list[tuple[str, int]]:
        """The files that a page lies in, each with the rows before it; their names come to the driver."""
        offsets = self.spark.read.parquet(f"{self.path}/offsets")
        inside = F.col("before") + F.col("rows") > offset
        if limit is not None:
            inside = inside & (F.col("before") < offset + limit)
        found = offsets.where(inside).orderBy("before").select("file", "before").collect()
        return [(row["file"], row["before"]) for row in found]

    def page(self, limit: int | None = None, offset: int = 0) -> DataFrame:
        """Rows ``offset+1 ... offset+limit`` in the stored order; beyond the last row there is nothing.

        The rows before the page's first file are known, so only those of its own files are counted."""
        found = self.files_of(offset, limit)
        if not found:
            return self.spark.read.parquet(f"{self.path}/rows").select(*self.columns).limit(0)
        rows = self.spark.read.parquet(*[file for file, _ in found])
        starts = self.spark.read.parquet(f"{self.path}/offsets").select(F.col("file").alias("_file"), "first", "before")
        named = rows.withColumn("_file", F.col("_metadata.file_path")).join(starts, "_file")
        # Within a file places are dense.
        position = F.col("before") + F.col(PLACE) - F.col("first") + 1
        wanted = position > offset
        if limit is not None:
            wanted = wanted & (position <= offset + limit)
        return named.where(wanted).orderBy(PLACE).select(*self.columns)
