"""A keyed table whose base stays where it is when rows are put in.

The table has folders by a hash of the key and, in every folder, buckets of the key.  Spark reads a
bucketed table as dealt out by its key already, so only the changes are moved to it; and only the
folders that hold changed keys are read and written.  All others keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.operators.grouping import last_wins
from trackmill.session import durable

FOLDER = "key_folder"


class BucketedTable:
    """Catalog table ``name`` at ``path``, each key once.

    Readers that began before a write may find files gone, as with any table rewritten in place; a
    write that fails leaves the folders it had not reached, and can be repeated with the same rows.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, key: str = "id", folders: int = 16,
                 buckets: int = 8) -> None:
        self.spark, self.name, self.path = spark, name, path
        self.key, self.folders, self.buckets = key, folders, buckets

    def folder(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.folders)).cast("int")

    def create(self, rows: DataFrame) -> None:
        """``rows``, each key once, as the table's first content; absent keys are not taken in."""
        # Dealt out as the buckets are, so that a task writes one bucket of each folder.
        dealt = rows.where(F.col(self.key).isNotNull()).repartition(self.buckets, self.key)
        dealt.withColumn(FOLDER, self.folder()).write.partitionBy(FOLDER).bucketBy(
            self.buckets, self.key
        ).sortBy(self.key).option("path", self.path).mode("overwrite").saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(FOLDER)

    def touched(self, keys: DataFrame) -> list[int]:
        """Folders that hold any of the keys: numbers below ``folders``."""
        found = keys.where(F.col(self.key).isNotNull()).select(self.folder().alias(FOLDER)).distinct().collect()
        return sorted(row[FOLDER] for row in found)

    def _base(self, folders: list[int]) -> DataFrame:
        return self.spark.table(self.name).where(F.col(FOLDER).isin(folders) if folders else F.lit(False))

    def put_plan(self, rows: DataFrame, order: Sequence[Column], folders: list[int]) -> DataFrame:
        """The touched folders with ``rows`` put in or replaced by key; of one key the last of ``order``
        wins.  Both sides of the join are dealt out by the key, the base by its buckets."""
        base = self._base(folders)
        columns = [name for name in base.columns if name != FOLDER]
        winners = last_wins(rows.where(F.col(self.key).isNotNull()), [self.key], order).select(*columns)
        named = winners.select(F.col(self.key).alias("_key"), F.struct(*columns).alias("_new"))
        # ``hint``: a broadcast of either side would leave new rows outside their buckets.
        both = base.join(named.hint("merge"), base[self.key] == F.col("_key"), "full")
        old = [F.when(F.col("_key").isNotNull(), F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name) for name in columns]
        return both.select(*old).withColumn(FOLDER, self.folder())

    def _write(self, rows: DataFrame) -> None:
        # Written first: Spark doesn't overwrite what it is reading.
        ready = durable(rows)
        ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(self.name)

    def put(self, rows: DataFrame, order: Sequence[Column]) -> list[int]:
        """Upsert ``rows``; returns the folders that were written."""
        rows = durable(rows)
        folders = self.touched(rows)
        if folders:
            self._write(self.put_plan(rows, order, folders))
        return folders

    def delete(self, keys: DataFrame) -> list[int]:
        """Delete by key; returns the folders that were written."""
        keys = durable(keys.select(self.key))
        folders = self.touched(keys)
        if folders:
            base = self._base(folders)
            self._drop_emptied(keys, folders)
            self._write(base.join(keys, self.key, "left_anti").select(*base.columns))
        return folders

    def _drop_emptied(self, keys: DataFrame, folders: list[int]) -> None:
        """A folder that lost all its rows has none to overwrite it with, so it is overwritten with
        nothing by name."""
        left = {row[FOLDER] for row in self._base(folders).join(keys, self.key, "left_anti").select(FOLDER).distinct().collect()}
        columns = ", ".join(f"`{name}`" for name in self.read().columns)
        nothing = durable(self.read().limit(0))
        nothing.createOrReplaceTempView("_no_rows")
        for folder in folders:
            if folder not in left:
                self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({FOLDER} = {folder}) SELECT {columns} FROM _no_rows")
        self.spark.catalog.dropTempView("_no_rows")
