"""First, last and top rows per key, and removal of repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmill.operators.scans import with_previous


def top_per_group(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], k: int
) -> DataFrame:
    """The first ``k`` rows of every group in the given order.

    Spark applies the rank limit inside each map task before the shuffle where it is below
    ``spark.sql.optimizer.windowGroupLimitThreshold``, so a group then sends at most ``k``
    rows per task however large it is.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    columns = df.columns
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).select(*columns)


def first_seen(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key in input order, which ``order`` states."""
    return top_per_group(df, keys, order, 1)


def last_wins(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the last row per key; ``order`` lists descending sort columns."""
    return top_per_group(df, keys, order, 1)


def first_by_text(df: DataFrame, text: str, order: Sequence[Column]) -> DataFrame:
    """Keep the first row per exact text.  Texts are told apart by their SHA-256 digest, so
    that rows are sorted and, where the text itself is not asked for, moved without it."""
    return first_seen(df, [F.sha2(F.col(text).cast("binary"), 256)], order)


def retain_last(runs: DataFrame, service: str, order: Sequence[Column], keep: int) -> DataFrame:
    """The last ``keep`` runs of every service; ``order`` lists descending sort columns."""
    if keep < 1:
        raise ValueError("at least one run must be kept")
    return top_per_group(runs, [service], order, keep)


def latest_per_project(issues: DataFrame, k: int = 3) -> DataFrame:
    """Most recently created issues of each project."""
    order = [F.col("created").desc(), F.col("issue_key"), F.col("id")]
    return top_per_group(issues.where(F.col("project_key").isNotNull()), ["project_key"], order, k)


def timeline(history: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Changes in time order inside each issue.

    One range sort on the composite key: a heavily edited issue spreads over as many
    partitions as it needs.
    """
    return history.orderBy("issue_key", "change_timestamp", *ties)


def timeline_gaps(
    history: DataFrame, ties: Sequence[str], before: str = "from_display_value", after: str = "to_display_value"
) -> DataFrame:
    """Changes that do not start where the change before of the same issue and field ended, with
    that end as ``expected``.  The first change of a field has nothing before it.

    A scan of the table sorted by issue, field and time: a heavily edited issue is cut
    wherever a range ends, and the scan carries one row over.
    """
    order = [F.col(name) for name in ("issue_key", "field_name", "change_timestamp", *ties)]
    seen = with_previous(history, order, [after], ["issue_key", "field_name"])
    broken = F.col("previous").isNotNull() & ~F.col(before).eqNullSafe(F.col(f"previous.{after}"))
    return seen.where(broken).select(*history.columns, F.col(f"previous.{after}").alias("expected"))
