"""Incremental synchronisation with a high-water mark for each project.

A project is fetched from where its own last success ended.  One that fails keeps its mark and
holds nobody back: the others move on, and only it is fetched over its longer span next time.
"""

from __future__ import annotations

from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.functions.instants import Instant, as_utc, instant
from trackmill.operators.filters import TimeWindow
from trackmill.operators.joins import classify
from trackmill.operators.sync import merge
from trackmill.session import durable

OTHERWISE_HOURS = 24


def project_marks(runs: DataFrame) -> DataFrame:
    """``project_key`` and ``since``, when its last successful run ended; nothing for a project that
    never had one.  A project's runs are ordered by ``run_id``."""
    return runs.where("is_success").groupBy("project_key").agg(F.max_by("end_time", "run_id").alias("since"))


def fetch_by_project(
    source: DataFrame, marks: DataFrame, as_of: Instant, otherwise_hours: int = OTHERWISE_HOURS
) -> DataFrame:
    """Issues created or updated from their project's mark on and up to ``as_of``, both included;
    without a mark, or without a project, from ``otherwise_hours`` before ``as_of``.

    The earliest mark, one value, bounds the scan by date; the join with the marks, of which a
    project has one, cuts each project to its own span.
    """
    otherwise = as_utc(as_of) - timedelta(hours=otherwise_hours)
    oldest = marks.agg(F.min("since")).first()[0]
    since = min(otherwise, as_utc(oldest)) if oldest is not None else otherwise
    near = TimeWindow.incremental_since(min(since, as_utc(as_of)), as_of).apply(source)
    known = marks.select("project_key", F.col("since").alias("_since"))
    own = F.coalesce(F.col("_since"), instant(otherwise).cast(marks.schema["since"].dataType))
    upto = instant(as_of)
    inside = [(F.col(at) >= own) & (F.col(at) <= upto) for at in ("created", "updated")]
    return near.join(known, "project_key", "left").where(inside[0] | inside[1]).select(*source.columns)


class ProjectOutcome(NamedTuple):
    """Fetched issues with their kind, the merged table, this run's row for each project, and
    all runs."""

    fetched: DataFrame
    merged: DataFrame
    record: DataFrame
    runs: DataFrame


def run_by_project(
    source: DataFrame, known: DataFrame, runs: DataFrame, as_of: Instant, failed: DataFrame | None = None,
    otherwise_hours: int = OTHERWISE_HOURS,
) -> ProjectOutcome:
    """Synchronise every project from its own mark and record the run of each.

    ``failed`` lists ``project_key`` and ``error_message`` of projects that could not be read:
    nothing of theirs is taken in, and their run is no success.  A project without changes
    succeeds.  ``runs`` has ``project_key``, ``run_id``, ``start_time``, ``end_time``, the counts and
    ``is_success``.  Issues without a project are taken in but have no run.
    """
    marks = durable(project_marks(runs))  # one row per project
    found = fetch_by_project(source, marks, as_of, otherwise_hours)
    if failed is not None:
        found = found.join(failed.select("project_key"), "project_key", "left_anti").select(*source.columns)
    fetched = durable(classify(durable(found), known, version="updated", few=True))
    counts = fetched.where(F.col("project_key").isNotNull()).groupBy("project_key").agg(
        F.count("*").alias("synced_count"),
        F.count_if(F.col("sync_kind") == "new").alias("new_count"),
        F.count_if(F.col("sync_kind") == "updated").alias("updated_count"),
    )
    spark = source.sparkSession
    errors = failed.groupBy("project_key").agg(F.min("error_message").alias("error_message")) if failed is not None else (
        spark.createDataFrame([], "project_key string, error_message string")
    )
    seen = runs.groupBy("project_key").agg(F.max("run_id").alias("_last"))
    everyone = seen.select("project_key").union(counts.select("project_key")).union(errors.select("project_key")).distinct()
    otherwise = instant(as_utc(as_of) - timedelta(hours=otherwise_hours)).cast(marks.schema["since"].dataType)
    zero = F.lit(0).cast("long")
    record = (
        everyone.join(seen, "project_key", "left").join(marks, "project_key", "left")
        .join(counts, "project_key", "left").join(errors.withColumn("_failed", F.lit(True)), "project_key", "left")
    ).select(
        "project_key", (F.coalesce("_last", zero) + 1).alias("run_id"), F.coalesce("since", otherwise).alias("start_time"),
        instant(as_of).cast(marks.schema["since"].dataType).alias("end_time"),
        *[F.coalesce(name, zero).alias(name) for name in ("synced_count", "new_count", "updated_count")],
        F.when(F.col("_failed"), 1).otherwise(0).cast("long").alias("error_count"),
        F.col("_failed").isNull().alias("is_success"), "error_message",
    )
    record = durable(record)
    return ProjectOutcome(fetched, merge(known, fetched), record, runs.unionByName(record, allowMissingColumns=True))
