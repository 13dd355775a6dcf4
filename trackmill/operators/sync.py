"""Incremental synchronisation: what to fetch, how to merge, what to record."""

from __future__ import annotations

from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.functions.instants import Instant, as_utc, elapsed_micros, instant
from trackmill.operators.filters import TimeWindow
from trackmill.operators.grouping import last_wins
from trackmill.operators.joins import classify
from trackmill.operators.upsert import upsert
from trackmill.session import durable


def _newest() -> list[Column]:
    """Of several versions of an issue the latest counts."""
    return [F.col("updated").desc(), F.col("issue_key")]


class SyncOutcome(NamedTuple):
    """Fetched issues with their kind, the merged table, and counts per project."""

    fetched: DataFrame
    merged: DataFrame
    projects: DataFrame


def fetch_changes(source: DataFrame, known: DataFrame, window: TimeWindow) -> DataFrame:
    """Issues of the window that are new or differ from their known version, classified.  The
    window is read once and written, so that the known table can be cut to its keys."""
    return classify(durable(window.apply(source)), known, version="updated", few=True)


def incremental(
    source: DataFrame, known: DataFrame, since: Instant, as_of: Instant, failed: DataFrame | None = None
) -> SyncOutcome:
    """Bring ``known`` up to ``source`` from the last successful run on.

    The fetched issues are few beside the table and used for every part of the outcome,
    so they are checkpointed once and not worked out for each.
    """
    fetched = durable(fetch_changes(source, known, TimeWindow.incremental_since(since, as_of)))
    return SyncOutcome(fetched, merge(known, fetched), project_rollup(fetched, as_of, failed))


def last_success(runs: DataFrame, service: str, as_of: Instant, otherwise_hours: int = 24) -> Instant:
    """When the service's last successful run ended, by the table of runs; without one,
    ``otherwise_hours`` before ``as_of``.  One row comes to the driver."""
    ended = runs.where(F.col("is_success") & (F.col("service") == service)).agg(
        F.max_by("end_time", "run_id").alias("ended")
    ).first()["ended"]
    return ended if ended is not None else as_utc(as_of) - timedelta(hours=otherwise_hours)


class SyncRun(NamedTuple):
    outcome: SyncOutcome
    record: DataFrame
    runs: DataFrame


def run_incremental(
    source: DataFrame, known: DataFrame, runs: DataFrame, service: str, as_of: Instant,
    failed: DataFrame | None = None,
) -> SyncRun:
    """Synchronise from where the table of runs says the last success ended, and add this
    run to the table.  ``failed`` lists projects with an ``error_message``; a run with any
    is no success, so the next one starts where this one did."""
    since = last_success(runs, service, as_of)
    outcome = incremental(source, known, since, as_of, failed)
    last_id = runs.where(F.col("service") == service).agg(F.max("run_id")).first()[0]
    record = run_record(
        outcome.projects, service, (last_id or 0) + 1, since, as_of, failed=failed
    )
    return SyncRun(outcome, record, runs.unionByName(record, allowMissingColumns=True))


def full(source: DataFrame, known: DataFrame, as_of: Instant) -> SyncOutcome:
    """Reload everything: no time filter, and known issues that are gone are dropped."""
    fetched = classify(source, known)
    merged = last_wins(source, ["id"], _newest())
    return SyncOutcome(fetched, merged, project_rollup(fetched, as_of))


def merge(known: DataFrame, fetched: DataFrame) -> DataFrame:
    return upsert(known, fetched, "id", _newest())


def project_rollup(
    fetched: DataFrame, as_of: Instant, failed: DataFrame | None = None
) -> DataFrame:
    """Synced, new and updated issues per project.  A project in ``failed`` counts one
    error and none of the issues read before it failed."""
    counts = fetched.where(F.col("project_key").isNotNull()).groupBy("project_key").agg(
        F.count("*").alias("synced_count"),
        F.count_if(F.col("sync_kind") == "new").alias("new_count"),
        F.count_if(F.col("sync_kind") == "updated").alias("updated_count"),
        F.lit(0).cast("long").alias("error_count"),
    )
    if failed is not None:
        errors = failed.select("project_key").distinct()
        none = F.lit(0).cast("long")
        counts = counts.join(errors, "project_key", "left_anti").unionByName(
            errors.select(
                "project_key", none.alias("synced_count"), none.alias("new_count"),
                none.alias("updated_count"), F.lit(1).cast("long").alias("error_count"),
            )
        )
    return counts.withColumn("last_sync_time", instant(as_of))


def run_record(projects: DataFrame, service: str, run_id: int, start: Instant, end: Instant,
               deleted: DataFrame | None = None, failed: DataFrame | None = None) -> DataFrame:
    """One row for the table of runs, summed over the projects of a run, with the sorted
    messages of its failed projects."""
    def summed(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    totals = projects.agg(*[summed(f"{kind}_count") for kind in ("synced", "new", "updated", "error")])
    # One message per failed project of one run.
    told = failed.agg(F.array_sort(F.collect_set("error_message"))).scalar() if failed is not None else F.array()
    messages = told.cast("array<string>")
    gone = deleted.agg(F.count("*")).scalar() if deleted is not None else F.lit(0).cast("long")
    return totals.select(
        F.lit(service).alias("service"), F.lit(run_id).cast("long").alias("run_id"),
        instant(start).alias("start_time"), instant(end).alias("end_time"),
        "synced_count", "new_count", "updated_count", gone.alias("deleted_count"), "error_count",
        (F.col("error_count") == 0).alias("is_success"),
        messages.alias("error_messages"),
    )


def deleted_keys(known: DataFrame, snapshot: DataFrame, key: str = "issue_key") -> DataFrame:
    """Known keys that a full snapshot no longer has."""
    return known.select(key).distinct().join(snapshot.select(key).distinct(), key, "left_anti")


def due(services: DataFrame, runs: DataFrame, interval_minutes: int, as_of: Instant) -> DataFrame:
    """Services to synchronise: whole minutes since the last success have reached the
    interval, or there never was a success."""
    last = runs.where("is_success").groupBy("service").agg(F.max_by("end_time", "run_id").alias("last_success"))
    minutes = F.floor(elapsed_micros(F.col("last_success"), instant(as_of)) / F.lit(60_000_000))
    state = services.select("service").distinct().join(last, "service", "left")
    state = state.withColumn("elapsed_minutes", minutes.cast("long"))
    return state.where(
        F.col("last_success").isNull() | (F.col("elapsed_minutes") >= F.lit(interval_minutes))
    )
