"""Queries of the time-chunk, incremental and streaming families."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions.instants import instant
from trackmill.operators import project_sync, sync
from trackmill.operators.chunks import covering_chunks, rows_per_chunk
from trackmill.operators.grouping import last_wins
from trackmill.plans.registry import query
from trackmill.plans.standins import (
    EVENTS_AS_OF,
    FLAT_SQL,
    ISSUES_SQL,
    ORDERS_AS_OF,
    RUNS_SQL,
    flat_issues,
    issues,
    owned_issues,
    runs,
    table,
)
from trackmill.session import durable, scratch_path
from trackmill.sources.tables import ChangeTable, save_table
from trackmill.streaming import incremental as streams
from trackmill.streaming import marks


@query("q_time_chunks", """
WITH span AS (SELECT MIN(ts) AS a, MAX(ts) AS b FROM events),
starts AS (SELECT b, UNNEST(GENERATE_SERIES(a, b - INTERVAL 1 MICROSECOND, INTERVAL 6 HOUR)) AS s FROM span)
SELECT (ROW_NUMBER() OVER (ORDER BY s) - 1) AS chunk, s AS chunk_start,
  LEAST(s + INTERVAL 6 HOUR, b) AS chunk_end,
  (EPOCH_US(LEAST(s + INTERVAL 6 HOUR, b)) - EPOCH_US(s)) // 1000000 AS duration_seconds,
  ROUND((EPOCH_US(LEAST(s + INTERVAL 6 HOUR, b)) - EPOCH_US(s)) // 1000000 / 3600.0, 6) AS duration_hours
FROM starts""")
def time_chunks(spark, sf_dir):
    chunks = covering_chunks(table(spark, sf_dir, "events"), "ts", 6)
    return chunks.withColumn("duration_hours", F.round("duration_hours", 6))


@query("q_chunk_counts", """
SELECT chunk, TIMESTAMP '2024-01-01' + CAST(chunk * 12 AS INTEGER) * INTERVAL 1 HOUR AS chunk_start,
  COUNT(*) AS n
FROM (SELECT LEAST(FLOOR((EPOCH_US(ts) - EPOCH_US(TIMESTAMP '2024-01-01')) / 43200000000.0), 59)::BIGINT
        AS chunk FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31')
GROUP BY chunk""")
def chunk_counts(spark, sf_dir):
    return rows_per_chunk(table(spark, sf_dir, "events"), "ts", "2024-01-01", "2024-01-31", 12)


# The state a first run left behind: issues created by then, as they were then.
SINCE = "2001-03-01 00:00:00"
SINCE_SQL = f"TIMESTAMP '{SINCE}'"
STATE = ("id", "issue_key", "project_key", "status_name", "created", "updated")


def _known(spark, sf_dir):
    before = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= instant(SINCE))
    changed = before.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("changed")).select(
        F.col("l_orderkey").cast("string").alias("id"), "changed"
    )
    earlier = owned_issues(spark, sf_dir).where(F.col("created") <= instant(SINCE)).select(*STATE[:-1])
    joined = earlier.join(changed, "id", "left")
    return joined.withColumn("updated", F.greatest("created", F.coalesce("changed", "created"))).drop("changed")


KNOWN_SQL = f"""
changed_then AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS then_id, MAX(l_shipdate) AS changed_then
  FROM lineitem WHERE l_shipdate <= {SINCE_SQL} GROUP BY l_orderkey),
known AS (
  SELECT id, issue_key, project_key, status_name, created,
         GREATEST(created, COALESCE(changed_then, created)) AS updated
  FROM issues LEFT JOIN changed_then ON id = then_id WHERE created <= {SINCE_SQL}),
fetched AS (
  SELECT i.id, i.issue_key, i.project_key, i.status_name, i.created, i.updated,
         CASE WHEN k.id IS NULL THEN 'new' ELSE 'updated' END AS sync_kind
  FROM issues i LEFT JOIN known k ON i.issue_key = k.issue_key
  WHERE (i.created BETWEEN {SINCE_SQL} AND TIMESTAMP '2001-08-01'
      OR i.updated BETWEEN {SINCE_SQL} AND TIMESTAMP '2001-08-01')
    AND (k.updated IS NULL OR k.updated <> i.updated))
"""


@query("q_incremental", f"""WITH {ISSUES_SQL}, {KNOWN_SQL}
SELECT {', '.join(STATE)} FROM fetched
UNION ALL SELECT {', '.join(STATE)} FROM known WHERE id NOT IN (SELECT id FROM fetched)""")
def incremental(spark, sf_dir):
    source = issues(spark, sf_dir).select(*STATE)
    return sync.incremental(source, _known(spark, sf_dir), SINCE, ORDERS_AS_OF).merged


@query("q_a17", f"""WITH {ISSUES_SQL}, {KNOWN_SQL}
SELECT project_key, COUNT(*) AS synced_count, COUNT(*) FILTER (sync_kind = 'new') AS new_count,
  COUNT(*) FILTER (sync_kind = 'updated') AS updated_count, CAST(0 AS BIGINT) AS error_count,
  TIMESTAMP '2001-08-01' AS last_sync_time
FROM fetched WHERE project_key IS NOT NULL GROUP BY project_key""")
def a17(spark, sf_dir):
    source = issues(spark, sf_dir).select(*STATE)
    return sync.incremental(source, _known(spark, sf_dir), SINCE, ORDERS_AS_OF).projects


@query("q_t4", f"""WITH {ISSUES_SQL}, {KNOWN_SQL} SELECT {', '.join(f'i.{c}' for c in STATE)},
  CASE WHEN k.id IS NULL THEN 'new' ELSE 'updated' END AS sync_kind
FROM issues i LEFT JOIN known k ON i.issue_key = k.issue_key""")
def t4(spark, sf_dir):
    source = issues(spark, sf_dir).select(*STATE)
    return sync.full(source, _known(spark, sf_dir), ORDERS_AS_OF).fetched


@query("q_t4_merged", f"""WITH {ISSUES_SQL} SELECT {', '.join(STATE)} FROM issues""")
def t4_merged(spark, sf_dir):
    source = issues(spark, sf_dir).select(*STATE)
    return sync.full(source, _known(spark, sf_dir), ORDERS_AS_OF).merged


@query("q_sync_rounds", f"""WITH {ISSUES_SQL}, {KNOWN_SQL},
merged AS (
  SELECT id, issue_key, updated FROM fetched
  UNION ALL SELECT id, issue_key, updated FROM known WHERE id NOT IN (SELECT id FROM fetched)),
fetched_next AS (
  SELECT i.project_key, CASE WHEN k.id IS NULL THEN 'new' ELSE 'updated' END AS sync_kind
  FROM issues i LEFT JOIN merged k ON i.issue_key = k.issue_key
  WHERE (i.created BETWEEN TIMESTAMP '2001-08-01' AND TIMESTAMP '2001-08-02'
      OR i.updated BETWEEN TIMESTAMP '2001-08-01' AND TIMESTAMP '2001-08-02')
    AND (k.updated IS NULL OR k.updated <> i.updated))
SELECT 'issues' AS service, CAST(run_id AS BIGINT) AS run_id, start_time, end_time, synced_count, new_count,
  updated_count, CAST(0 AS BIGINT) AS error_count, TRUE AS is_success FROM (
  SELECT 2 AS run_id, {SINCE_SQL} AS start_time, TIMESTAMP '2001-08-01' AS end_time, COUNT(*) AS synced_count,
    COUNT(*) FILTER (sync_kind = 'new') AS new_count, COUNT(*) FILTER (sync_kind = 'updated') AS updated_count
  FROM fetched WHERE project_key IS NOT NULL
  UNION ALL SELECT 3, TIMESTAMP '2001-08-01', TIMESTAMP '2001-08-02', COUNT(*),
    COUNT(*) FILTER (sync_kind = 'new'), COUNT(*) FILTER (sync_kind = 'updated')
  FROM fetched_next WHERE project_key IS NOT NULL)
UNION ALL SELECT 'issues', 1, {SINCE_SQL} - INTERVAL 1 HOUR, {SINCE_SQL}, 0, 0, 0, 0, TRUE""")
def sync_rounds(spark, sf_dir):
    """Two rounds, each from where the table of runs says that the one before ended."""
    source, known = issues(spark, sf_dir).select(*STATE), _known(spark, sf_dir)
    zero = F.lit(0).cast("long")
    first = spark.range(1, 2).select(
        F.lit("issues").alias("service"), F.col("id").alias("run_id"),
        (instant(SINCE) - F.expr("INTERVAL 1 HOUR")).alias("start_time"), instant(SINCE).alias("end_time"),
        *[zero.alias(f"{kind}_count") for kind in ("synced", "new", "updated", "error")],
        F.lit(True).alias("is_success"),
    )
    one = sync.run_incremental(source, known, first, "issues", ORDERS_AS_OF)
    two = sync.run_incremental(source, one.outcome.merged, one.runs, "issues", "2001-08-02 00:00:00")
    return two.runs.select(*first.columns)


# Earlier runs: the projects' last successes differ, one has only failed, one has never run.
PROJECT_RUNS = [
    ("AUTOMOBILE", 1, "2001-02-01 00:00:00", True), ("AUTOMOBILE", 2, "2001-06-01 00:00:00", True),
    ("BUILDING", 1, SINCE, True), ("BUILDING", 2, "2001-07-01 00:00:00", False),
    ("FURNITURE", 1, "2001-07-15 00:00:00", False),
]
PROJECT_RUNS_SQL = ", ".join(
    f"('{project}', CAST({run_id} AS BIGINT), TIMESTAMP '{end}', {success})" for project, run_id, end, success in PROJECT_RUNS
)
NEXT_AS_OF = "2001-08-02 00:00:00"


def _project_run_sql(name: str, runs: str, known: str, as_of: str, failed: str) -> str:
    """Marks, fetched issues, record and merged table of one run."""
    return f"""
{name}_marks AS (SELECT project_key, ARG_MAX(end_time, run_id) AS since FROM {runs} WHERE is_success GROUP BY project_key),
{name}_fetched AS (
  SELECT i.id, i.issue_key, i.project_key, i.status_name, i.created, i.updated,
         CASE WHEN k.id IS NULL THEN 'new' ELSE 'updated' END AS sync_kind
  FROM issues i LEFT JOIN {known} k ON i.issue_key = k.issue_key
    LEFT JOIN {name}_marks m ON i.project_key = m.project_key
  WHERE (i.created BETWEEN COALESCE(since, TIMESTAMP '{as_of}' - INTERVAL 24 HOUR) AND TIMESTAMP '{as_of}'
      OR i.updated BETWEEN COALESCE(since, TIMESTAMP '{as_of}' - INTERVAL 24 HOUR) AND TIMESTAMP '{as_of}')
    AND (k.updated IS NULL OR k.updated <> i.updated) AND i.project_key IS DISTINCT FROM '{failed}'),
{name}_everyone AS (
  SELECT project_key FROM {runs} UNION SELECT project_key FROM {name}_fetched WHERE project_key IS NOT NULL
  UNION SELECT '{failed}' WHERE '{failed}' <> ''),
{name}_record AS (
  SELECT e.project_key, COALESCE((SELECT MAX(run_id) FROM {runs} r WHERE r.project_key = e.project_key), 0) + 1 AS run_id,
    COALESCE(since, TIMESTAMP '{as_of}' - INTERVAL 24 HOUR) AS start_time, TIMESTAMP '{as_of}' AS end_time,
    (SELECT COUNT(*) FROM {name}_fetched f WHERE f.project_key = e.project_key) AS synced_count,
    (SELECT COUNT(*) FROM {name}_fetched f WHERE f.project_key = e.project_key AND sync_kind = 'new') AS new_count,
    e.project_key <> '{failed}' AS is_success
  FROM {name}_everyone e LEFT JOIN {name}_marks m ON e.project_key = m.project_key),
{name}_runs AS (
  SELECT project_key, run_id, end_time, is_success FROM {runs}
  UNION ALL SELECT project_key, run_id, end_time, is_success FROM {name}_record),
{name}_merged AS (
  SELECT {', '.join(STATE)} FROM {name}_fetched
  UNION ALL SELECT {', '.join(STATE)} FROM {known} WHERE id NOT IN (SELECT id FROM {name}_fetched))"""


PROJECT_ROUNDS_SQL = f"""WITH {ISSUES_SQL}, {KNOWN_SQL},
earlier AS (SELECT * FROM (VALUES {PROJECT_RUNS_SQL}) AS r(project_key, run_id, end_time, is_success)),
{_project_run_sql('one', 'earlier', 'known', ORDERS_AS_OF, 'MACHINERY')},
{_project_run_sql('two', 'one_runs', 'one_merged', NEXT_AS_OF, '')}"""
RECORD = ("project_key", "run_id", "start_time", "end_time", "synced_count", "new_count", "is_success")


def _project_rounds(spark, sf_dir):
    """Two runs by project: in the first one project cannot be read."""
    source, known = issues(spark, sf_dir).select(*STATE), _known(spark, sf_dir)
    runs = spark.createDataFrame(PROJECT_RUNS, "project_key string, run_id long, end_time string, is_success boolean")
    runs = runs.withColumn("end_time", F.col("end_time").cast("timestamp_ntz"))
    failed = spark.createDataFrame([("MACHINERY", "no answer")], "project_key string, error_message string")
    one = project_sync.run_by_project(source, known, runs, ORDERS_AS_OF, failed)
    two = project_sync.run_by_project(source, durable(one.merged), one.runs, NEXT_AS_OF)
    return one, two


@query("q_t3_projects", f"""{PROJECT_ROUNDS_SQL}
SELECT {', '.join(RECORD)} FROM one_record UNION ALL SELECT {', '.join(RECORD)} FROM two_record""")
def project_rounds(spark, sf_dir):
    one, two = _project_rounds(spark, sf_dir)
    return one.record.select(*RECORD).union(two.record.select(*RECORD))


@query("q_t3_projects_merged", f"{PROJECT_ROUNDS_SQL} SELECT {', '.join(STATE)} FROM two_merged")
def project_rounds_merged(spark, sf_dir):
    return _project_rounds(spark, sf_dir)[1].merged


@query("q_deleted_keys", """SELECT DISTINCT user_id FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-29')""")
def deleted(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return sync.deleted_keys(events, events.where(F.col("ts") >= instant("2024-01-29")), "user_id")


@query("q_due_projects", f"""
WITH {RUNS_SQL}, state AS (
  SELECT service, ARG_MAX(end_time, run_id) FILTER (is_success) AS last_success
  FROM runs GROUP BY service)
SELECT service, last_success,
  (EPOCH_US(TIMESTAMP '2024-01-31') - EPOCH_US(last_success)) // 60000000 AS elapsed_minutes
FROM state WHERE last_success IS NULL
  OR (EPOCH_US(TIMESTAMP '2024-01-31') - EPOCH_US(last_success)) // 60000000 >= 2880""")
def due_projects(spark, sf_dir):
    everything = runs(spark, sf_dir)
    return sync.due(everything, everything, 2880, EVENTS_AS_OF)


# --- streams -----------------------------------------------------------------


@query("q_t6", "SELECT event_id, ts, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Two overlapping drops through a stream; every event comes out once."""
    source, drop = table(spark, sf_dir, "events"), scratch_path(spark, "drops")
    source.where(F.col("ts") < instant("2024-01-20")).write.parquet(f"{drop}/drop=1")
    source.where(F.col("ts") >= instant("2024-01-10")).write.parquet(f"{drop}/drop=2")
    stream = streams.drops(spark, drop, source.schema, "ts").select("event_id", "ts", "event_type")
    unique = streams.deduplicated(stream, "event_id", "ts", "60 days")
    out = streams.run_to_end(unique, scratch_path(spark, "unique"), scratch_path(spark, "offsets"))
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("q_t7", """
SELECT TIME_BUCKET(INTERVAL 1 HOUR, ts) AS window_start, event_type, COUNT(*) AS n FROM events
GROUP BY 1, 2 HAVING TIME_BUCKET(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
  <= (SELECT DATE_TRUNC('millisecond', MAX(ts)) FROM events) - INTERVAL 1 HOUR""")
def stream_counts(spark, sf_dir):
    """Changes per field and hour, as far as the watermark has closed the hours."""
    schema = table(spark, sf_dir, "events").schema
    stream = streams.table_drops(spark, f"{sf_dir}/events.parquet", schema, "ts")
    counts = streams.counts_per_field(stream, "ts", "event_type", "1 hour", "1 hour")
    out = streams.run_to_end(counts, scratch_path(spark, "counts"), scratch_path(spark, "offsets"))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("q_t3", """SELECT user_id AS id, ARG_MAX(event_type, ts) AS event_type, MAX(ts) AS updated
FROM events GROUP BY user_id""")
def stream_upsert(spark, sf_dir):
    """Later events streamed as upserts into the state of the earlier ones, the newest drop
    first.  A drop has as many files as Spark writes; a micro-batch takes a few."""
    source = table(spark, sf_dir, "events")
    base, changes = scratch_path(spark, "base"), scratch_path(spark, "changes")
    drop = scratch_path(spark, "drops")
    later = source.where(F.col("ts") >= instant("2024-01-15"))
    days = [instant(f"2024-01-{day}") for day in (15, 20, 25)] + [instant("2100-01-01")]
    for start, end in reversed(list(zip(days, days[1:], strict=False))):
        later.where((F.col("ts") >= start) & (F.col("ts") < end)).write.mode("append").parquet(drop)
    shaped = [F.col("user_id").alias("id"), "event_type", F.col("ts").cast("timestamp").alias("updated")]
    earlier = source.where(F.col("ts") < instant("2024-01-15")).select(*shaped)
    store = ChangeTable(spark, base, changes)
    save_table(last_wins(earlier, ["id"], [F.col("updated").desc()]), base)
    stream = streams.drops(spark, drop, source.schema, "ts", files_per_trigger=8).select(*shaped)
    streams.upsert_stream(stream, store, scratch_path(spark, "offsets")).awaitTermination()
    return store.current().withColumn("updated", F.col("updated").cast("timestamp_ntz"))


@query("q_t3_marks", """
SELECT project_key, last_success,
  DATE_TRUNC('millisecond', last_success) + INTERVAL 180 MINUTE <= (SELECT DATE_TRUNC('millisecond', MAX(ts)) FROM events) - INTERVAL 1 HOUR AS overdue
FROM (SELECT 'user-' || user_id AS project_key, MAX(ts) FILTER (event_type <> 'error') AS last_success FROM events GROUP BY user_id)
WHERE last_success IS NOT NULL""")
def project_marks(spark, sf_dir):
    """Events as run reports of their users' projects, streamed into marks."""
    schema = table(spark, sf_dir, "events").schema
    reports = streams.table_drops(spark, f"{sf_dir}/events.parquet", schema, "ts").select(
        F.concat(F.lit("user-"), "user_id").alias("project_key"), F.col("ts").alias("end_time"),
        (F.col("event_type") != "error").alias("is_success"),
    )
    told = marks.project_mark_stream(reports, 180, "1 hour")
    found = marks.marks_of(streams.run_to_end(told, scratch_path(spark, "marks"), scratch_path(spark, "offsets")))
    return found.withColumn("last_success", F.col("last_success").cast("timestamp_ntz"))


@query("q_t1", f"""WITH {FLAT_SQL},
span AS (SELECT MIN(created) AS a, MAX(created) AS b FROM flat_issues),
starts AS (SELECT b, UNNEST(GENERATE_SERIES(a, b - INTERVAL 1 MICROSECOND, INTERVAL 720 HOUR)) AS s FROM span)
SELECT CAST(COUNT(*) AS BIGINT) AS chunks, CAST(SUM((EPOCH_US(LEAST(s + INTERVAL 720 HOUR, b)) - EPOCH_US(s)) // 1000000) AS BIGINT)
  AS covered_seconds FROM starts""")
def t1(spark, sf_dir):
    chunks = covering_chunks(flat_issues(spark, sf_dir), "created", 720)
    return chunks.agg(F.count("*").alias("chunks"), F.sum("duration_seconds").alias("covered_seconds"))


@query("q_t2", """SELECT TIME_BUCKET(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS chunk_start,
  event_type, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def t2(spark, sf_dir):
    tumbling = F.window("ts", "6 hours", startTime="0 seconds")
    counted = table(spark, sf_dir, "events").groupBy(tumbling.alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("chunk_start"), "event_type", "n")
