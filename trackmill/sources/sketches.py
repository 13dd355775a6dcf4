"""Distinct counts of stored history from mergeable sketches, kept by month and project.

A sketch of a month merges with others into that of a longer span, so a count over years reads a
few rows and none of the history.  Counts are estimates: with ``LG`` = 14 the standard error is
0.0081 of the count (1.04 over the root of 2 ** LG).  ``history_stats`` counts exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.functions.instants import as_utc
from trackmill.operators.filters import MONTH, DateRange, months_between
from trackmill.sources.tables import with_month

LG = 14
STANDARD_ERROR = 1.04 / 2 ** (LG / 2)


def month_sketches(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per month, and per column of ``by`` (``project_key``, say): changes, first and last time,
    and sketches of the issues and authors."""
    months = history if MONTH in history.columns else with_month(history)
    return months.groupBy(MONTH, *by).agg(
        F.count("*").alias("changes"), F.min("change_timestamp").alias("first_change"),
        F.max("change_timestamp").alias("last_change"), F.hll_sketch_agg("issue_key", LG).alias("issues"),
        F.hll_sketch_agg("author_account_id", LG).alias("authors"),
    )


def save_sketches(history: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Write the sketches of all months of ``history`` and hand them back.  Called with new months only,
    or again with some months, it replaces those and leaves the others."""
    rows = month_sketches(history, by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return history.sparkSession.read.parquet(path)


def cut_months(span: DateRange) -> list[date]:
    """The months, two at most, of which a span has a part only.  Both its ends are included."""
    start, behind = as_utc(span.start), as_utc(span.end) + timedelta(microseconds=1)
    last = as_utc(span.end)
    found = {edge.date().replace(day=1) for edge, at in ((start, start), (last, behind)) if at != month_start(at)}
    return sorted(found)


def month_start(at: datetime) -> datetime:
    return datetime(at.year, at.month, 1)


def sketched_stats(
    sketches: DataFrame, span: DateRange | None = None, history: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Changes, estimated issues and authors, and first and last time, per column of ``by`` or of all.

    A span made of whole months reads sketches only.  Where it starts or ends within a month, that
    month's changes are sketched from ``history``, of which only these months are read; without it
    such a span is an error.
    """
    parts = [*by, "changes", "first_change", "last_change", "issues", "authors"]
    rows = sketches
    if span is not None:
        cut = cut_months(span)
        whole = rows.where(months_between(span.start, span.end))
        rows = whole.where(~F.col(MONTH).isin(cut)) if cut else whole
        if cut:
            if history is None:
                raise ValueError("a span that cuts a month needs the history of that month")
            months = history if MONTH in history.columns else with_month(history)
            edges = months.where(F.col(MONTH).isin(cut) & span.condition("change_timestamp"))
            rows = rows.select(*parts).unionByName(month_sketches(edges, by).select(*parts))
    grouped = rows.groupBy(*by) if by else rows.groupBy()
    return grouped.agg(
        F.coalesce(F.sum("changes"), F.lit(0)).alias("total_changes"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("issues")), F.lit(0)).alias("unique_issues"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("authors")), F.lit(0)).alias("unique_authors"),
        F.min("first_change").alias("oldest_change"), F.max("last_change").alias("newest_change"),
    )
