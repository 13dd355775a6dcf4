"""Key-based upsert and delete as DataFrame transformations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.operators.grouping import last_wins


def upsert(
    target: DataFrame, incoming: DataFrame, key: str, order: Sequence[Column]
) -> DataFrame:
    """``target`` with the rows of ``incoming`` put in or replaced by ``key``.

    Of several incoming rows with one key the last wins; ``order`` lists descending sort
    columns of ``incoming``.  Every column is replaced.
    """
    winners = last_wins(incoming, [key], order).select(*target.columns)
    kept = target.join(incoming.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(winners)


def delete_keys(rows: DataFrame, keys: DataFrame, key: str = "issue_key") -> DataFrame:
    """Rows whose key is not listed; an empty list deletes nothing."""
    return rows.join(keys.select(key), key, "left_anti").select(*rows.columns)


def deleted_rows(rows: DataFrame, keys: DataFrame, key: str = "issue_key") -> DataFrame:
    """The rows a delete removes; their count is what it reports."""
    return rows.join(keys.select(key), key, "left_semi").select(*rows.columns)


def duplicate_keys(issues: DataFrame, key: str = "issue_key", unique: str = "id") -> DataFrame:
    """Keys carried by more than one id, which an upsert by id does not prevent."""
    ids = issues.groupBy(key, unique).agg(F.lit(1).alias("_one"))
    return ids.groupBy(key).agg(F.count("*").alias("ids")).where(F.col("ids") > 1)


def change_feed(
    target: DataFrame, incoming: DataFrame, key: str, order: Sequence[Column], deleted: DataFrame | None = None
) -> DataFrame:
    """What an upsert of ``incoming`` and a delete of the keys in ``deleted`` change: ``key``, the row
    ``before`` and the row ``after``, each null where there is none.

    A key that is both deleted and incoming is replaced.  Of the target, which has each key once, only
    the rows of these keys are moved.  Whoever keeps something up from the target (statistics, digests)
    needs the feed alone, so write it once.
    """
    row = F.struct(*[F.col(name) for name in target.columns])
    after = last_wins(incoming, [key], order).select(*target.columns).select(F.col(key).alias("_key"), row.alias("after"))
    if deleted is not None:
        gone = deleted.select(F.col(key).alias("_key")).distinct().join(after.select("_key"), "_key", "left_anti")
        after = after.unionByName(gone.withColumn("after", F.lit(None).cast(after.schema["after"].dataType)))
    before = target.select(F.col(key).alias("_key"), row.alias("before"))
    feed = after.join(before, "_key", "left").where(F.col("before").isNotNull() | F.col("after").isNotNull())
    return feed.select(F.col("_key").alias(key), "before", "after")


def apply_feed(target: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """``target`` with the changes of a feed made."""
    kept = target.join(feed.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(feed.where(F.col("after").isNotNull()).select("after.*"))
