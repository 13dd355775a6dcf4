"""Writing and maintaining the tables.

A table is never overwritten while it is being read: rewrites go to a new path, which the
caller makes current.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trackmill.operators.filters import MONTH
from trackmill.operators.grouping import last_wins
from trackmill.operators.stats import storage_stats
from trackmill.operators.upsert import upsert
from trackmill.session import durable

CREATED_DATE = "created_date"
NATURAL_HISTORY_KEY = ("issue_id", "change_id", "item_pos")


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    seen = Observation(label)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def save_json(df: DataFrame, path: str, compressed: bool = True) -> int:
    """Replace the JSON lines at ``path``; the rows are counted as they are written."""
    rows, seen = _counted(df, "save_json")
    codec = "gzip" if compressed else "none"
    rows.write.mode("overwrite").option("compression", codec).json(path)
    return seen.get["rows"]


def save_documents(documents: DataFrame, path: str, compressed: bool = True) -> int:
    """Replace the issue documents at ``path``, one ``raw_json`` per line."""
    rows, seen = _counted(documents.select("raw_json"), "save_documents")
    codec = "gzip" if compressed else "none"
    rows.write.mode("overwrite").option("compression", codec).text(path)
    return seen.get["rows"]


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    rows, seen = _counted(df, "save_table")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partition_by
    ).parquet(path)
    return seen.get["rows"]


def content() -> Column:
    """All of a row as one number, to decide between rows that their order does not."""
    return F.expr("xxhash64(struct(*))")


def with_month(history: DataFrame) -> DataFrame:
    """History with the month it is partitioned by."""
    return history.withColumn(MONTH, F.to_date(F.date_trunc("month", "change_timestamp")))


def append_history(history: DataFrame, path: str, only_new: bool = True) -> int:
    """Append changes to the history table, partitioned by month of change.

    With ``only_new`` a change already stored is not stored again, so a repeated run adds
    nothing.  Only the months that the new rows hold are read back to tell.
    """
    rows = with_month(history)
    stored = table_or_none(history.sparkSession, path) if only_new else None
    if stored is not None:
        rows = durable(rows)  # its months and its rows are both asked for
        months = rows.select(MONTH).distinct()
        seen_keys = stored.join(months, MONTH, "left_semi").select(*NATURAL_HISTORY_KEY)
        rows = rows.join(seen_keys, list(NATURAL_HISTORY_KEY), "left_anti")
    if only_new:
        rows = last_wins(rows, list(NATURAL_HISTORY_KEY), [F.col("change_timestamp").desc(), content().desc()])
    # Rebalancing gathers each month into few files and still splits a heavy month.
    rows, seen = _counted(rows.hint("rebalance", MONTH), "append_history")
    rows.write.mode("append").partitionBy(MONTH).parquet(path)
    return seen.get["rows"]


def overwrite_history(history: DataFrame, path: str) -> int:
    return save_table(with_month(history).hint("rebalance", MONTH), path, [MONTH])


def save_stats(issues: DataFrame, path: str) -> DataFrame:
    """Write the statistics beside the data and hand back the stored snapshot."""
    storage_stats(issues).write.mode("overwrite").parquet(path)
    return issues.sparkSession.read.parquet(path)


def save_issues(issues: DataFrame, path: str) -> int:
    """Issues partitioned by the date they were created, which
    ``IssueFilter.apply(…, created_date=CREATED_DATE)`` reads by."""
    dated = issues.withColumn(CREATED_DATE, F.to_date("created"))
    return save_table(dated.hint("rebalance", CREATED_DATE), path, [CREATED_DATE])


def compact(issues: DataFrame, path: str, max_records: int = 5_000_000, partitions: int | None = None) -> DataFrame:
    """Rewrite to ``path`` sorted by project and creation time, in ``partitions`` ranges or as
    many as the session has shuffle partitions.

    The unique id closes the range key, so one large project is cut into as many files as
    it needs; sorted files let a scan skip by their minimum and maximum.
    """
    key = ["project_key", "created", "id"]
    ranged = issues.repartitionByRange(partitions, *key) if partitions else issues.repartitionByRange(*key)
    laid_out = ranged.sortWithinPartitions(*key)
    laid_out.write.mode("overwrite").option("maxRecordsPerFile", max_records).parquet(path)
    return issues.sparkSession.read.parquet(path)


def analyze(spark: SparkSession, table: str) -> None:
    """Refresh statistics of a catalog table."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


class ChangeTable:
    """A keyed table as a base and batches of changes over it.

    Taking in a batch writes only that batch, under its source and number, so that a repeated
    batch replaces itself and no other.  Readers see the row of the newest version per key, of
    equal versions the one of the later batch; inside a batch ``position``, where rows carry
    one, says which came later, and otherwise their content decides, the same on every run.
    Batches may come in any order.  :meth:`compact_to` folds the batches into a new base.
    """

    def __init__(self, spark: SparkSession, base: str, changes: str, key: str = "id",
                 version: str = "updated", position: str | None = None) -> None:
        self.spark, self.base, self.changes = spark, base, changes
        self.key, self.version, self.position = key, version, position

    def take_in(self, batch: DataFrame, batch_id: int, source: str = "batch") -> None:
        later = [F.col(self.position).desc()] if self.position else []
        rows = last_wins(batch, [self.key], [F.col(self.version).desc(), *later, content().desc()])
        rows.write.mode("overwrite").parquet(f"{self.changes}/source={source}/batch_id={batch_id}")

    def current(self) -> DataFrame | None:
        """Newest row per key.  Only the batches and the base rows of their keys are ranked;
        all other base rows are kept as they are, so few changes leave the base unshuffled."""
        base = table_or_none(self.spark, self.base)
        batches = table_or_none(self.spark, self.changes)
        if batches is None:
            return base
        later = [F.col(self.position).desc()] if self.position else []
        newest = [
            F.col(self.version).desc_nulls_last(), F.col("batch_id").desc(), F.col("source").desc(), *later,
            content().desc(),
        ]
        if base is None:
            return last_wins(batches, [self.key], newest).drop("source", "batch_id")
        # A base row takes part as a batch before all others.
        touched = base.join(batches.select(self.key), self.key, "left_semi").select(
            *base.columns, F.lit("").alias("source"), F.lit(-1).alias("batch_id")
        )
        return upsert(base, batches.unionByName(touched), self.key, newest)

    def compact_to(self, path: str) -> DataFrame:
        rows = self.current()
        if rows is None:
            raise ValueError("the table has neither a base nor changes")
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)
