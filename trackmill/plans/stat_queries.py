"""Queries of the aggregation family."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions.instants import instant
from trackmill.operators import stats
from trackmill.operators.filters import DateRange, IssueFilter
from trackmill.operators.joins import classify
from trackmill.operators.ordering import numbered
from trackmill.operators.sync import project_rollup
from trackmill.plans.registry import query
from trackmill.plans.standins import (
    FLAT_SQL,
    HISTORY_SQL,
    ISSUES_SQL,
    LABELLED_SQL,
    ORDERS_AS_OF,
    OWNED_SQL,
    RUNS_SQL,
    flat_issues,
    history,
    issues,
    labelled_documents,
    owned_issues,
    runs,
    table,
)
from trackmill.session import scratch_path
from trackmill.sources.tables import overwrite_history


@query("q_a1", "SELECT COUNT(*) AS total_issues FROM orders")
def a1(spark, sf_dir):
    return stats.total(flat_issues(spark, sf_dir))


@query("q_by_project", f"""WITH {OWNED_SQL} SELECT project_key, COUNT(*) AS n FROM owned_issues
WHERE project_key IS NOT NULL GROUP BY project_key""")
def by_project(spark, sf_dir):
    return stats.count_by_project(owned_issues(spark, sf_dir))


@query("q_by_status", f"WITH {FLAT_SQL} SELECT status_name, COUNT(*) AS n FROM flat_issues GROUP BY status_name")
def by_status(spark, sf_dir):
    return stats.count_by(flat_issues(spark, sf_dir), "status_name")


@query("q_by_type", f"""WITH {FLAT_SQL} SELECT issue_type_name, COUNT(*) AS n FROM flat_issues
GROUP BY issue_type_name""")
def by_type(spark, sf_dir):
    return stats.count_by(flat_issues(spark, sf_dir), "issue_type_name")


STORAGE_STATS_SQL = f"""WITH {OWNED_SQL}
SELECT 'total' AS metric, CAST(NULL AS VARCHAR) AS key, COUNT(*) AS n FROM owned_issues
UNION ALL SELECT 'project', project_key, COUNT(*) FROM owned_issues
  WHERE project_key IS NOT NULL GROUP BY project_key
UNION ALL SELECT 'status', status_name, COUNT(*) FROM owned_issues GROUP BY status_name
UNION ALL SELECT 'type', issue_type_name, COUNT(*) FROM owned_issues GROUP BY issue_type_name"""


@query("q_storage_stats", STORAGE_STATS_SQL)
def storage_stats(spark, sf_dir):
    return stats.storage_stats(owned_issues(spark, sf_dir))


@query("q_count_filtered", f"""WITH {OWNED_SQL} SELECT COUNT(*) AS n FROM owned_issues
WHERE project_key = 'FURNITURE' AND status_name IN ('F', 'O')""")
def count_filtered(spark, sf_dir):
    spec = IssueFilter(project_keys=["FURNITURE"], statuses=["F", "O"], limit=10, offset=5)
    return stats.count_matching(owned_issues(spark, sf_dir), spec)


@query("q_history_stats", f"""WITH {HISTORY_SQL} SELECT COUNT(*) AS total_changes,
  COUNT(DISTINCT issue_key) AS unique_issues, COUNT(DISTINCT author_account_id) AS unique_authors,
  MIN(change_timestamp) AS oldest_change, MAX(change_timestamp) AS newest_change FROM history""")
def history_stats(spark, sf_dir):
    return stats.history_stats(history(spark, sf_dir))


@query("q_field_counts", f"WITH {HISTORY_SQL} SELECT field_name, COUNT(*) AS n FROM history GROUP BY field_name")
def field_counts(spark, sf_dir):
    return stats.changes_per_field(history(spark, sf_dir))


CHANGE_GROUP_SQL = """CASE field_name WHEN 'status' THEN 'Status Changes'
  WHEN 'assignee' THEN 'Assignee Changes' WHEN 'priority' THEN 'Priority Changes'
  ELSE CASE WHEN field_id IS NOT NULL THEN 'Custom Field Changes' ELSE 'Other Changes' END END"""


@query("q_change_type_counts", f"""WITH {HISTORY_SQL} SELECT {CHANGE_GROUP_SQL} AS change_group,
  COUNT(*) AS n FROM history GROUP BY 1""")
def change_type_counts(spark, sf_dir):
    return stats.change_type_counts(history(spark, sf_dir))


@query("q_a9", f"""WITH {HISTORY_SQL} SELECT {CHANGE_GROUP_SQL} AS change_group, issue_key,
  change_id, change_timestamp FROM history""")
def a9(spark, sf_dir):
    grouped = stats.with_change_group(history(spark, sf_dir))
    return grouped.select("change_group", "issue_key", "change_id", "change_timestamp")


@query("q_author_field", f"""WITH {HISTORY_SQL} SELECT author_display_name, field_name,
  COUNT(*) AS change_count,
  ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, author_display_name NULLS FIRST, field_name) AS position
FROM history WHERE change_timestamp >= TIMESTAMP '1998-01-01'
GROUP BY author_display_name, field_name""")
def author_field(spark, sf_dir):
    return numbered(stats.author_field_counts(history(spark, sf_dir), "1998-01-01"))


@query("q_assignee_top", f"""WITH {OWNED_SQL}
SELECT COALESCE(assignee_display_name, 'unassigned') AS assignee_display_name, COUNT(*) AS n
FROM owned_issues GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5""")
def assignee_top(spark, sf_dir):
    people = owned_issues(spark, sf_dir)
    return stats.top_values(people, "assignee_display_name", 5, stats.UNASSIGNED)


@query("q_a11", f"""WITH {OWNED_SQL} SELECT project_key, priority_name, COUNT(*) AS n
FROM owned_issues WHERE priority_name IS NOT NULL GROUP BY project_key, priority_name""")
def a11(spark, sf_dir):
    return stats.distribution(owned_issues(spark, sf_dir), ["project_key"], "priority_name")


@query("q_share", f"""WITH {OWNED_SQL} SELECT project_key, COUNT(*) AS n,
  ROUND(100.0 * COUNT(*) / (SELECT COUNT(*) FROM owned_issues), 4) AS percent
FROM owned_issues WHERE project_key IS NOT NULL GROUP BY project_key
ORDER BY n DESC, project_key LIMIT 5""")
def share(spark, sf_dir):
    return stats.share_of_total(owned_issues(spark, sf_dir), "project_key", 5)


@query("q_project_status_share", f"""WITH {OWNED_SQL},
combined AS (SELECT COALESCE(project_key, 'none') || ' / ' || status_name AS project_status
             FROM owned_issues)
SELECT project_status, COUNT(*) AS n,
  ROUND(100.0 * COUNT(*) / (SELECT COUNT(*) FROM combined), 4) AS percent
FROM combined GROUP BY project_status""")
def project_status_share(spark, sf_dir):
    project = F.coalesce("project_key", F.lit("none"))
    combined = F.concat_ws(" / ", project, "status_name").alias("project_status")
    return stats.share_of_total(owned_issues(spark, sf_dir).select(combined), "project_status")


@query("q_creation_rate", f"""WITH {FLAT_SQL} SELECT
  COUNT(*) FILTER (created >= TIMESTAMP '2001-07-25') AS created_7d,
  ROUND(COUNT(*) FILTER (created >= TIMESTAMP '2001-07-25') / 7.0, 6) AS rate_7d,
  COUNT(*) AS created_30d, ROUND(COUNT(*) / 30.0, 6) AS rate_30d
FROM flat_issues WHERE created BETWEEN TIMESTAMP '2001-07-02' AND TIMESTAMP '2001-08-01'""")
def creation_rate(spark, sf_dir):
    return stats.creation_rate(flat_issues(spark, sf_dir), ORDERS_AS_OF)


@query("q_a14", """SELECT COALESCE(NULLIF(p_type, 'PROMO'), 'unknown') AS p_type, COUNT(*) AS n
FROM part GROUP BY 1""")
def a14(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.nullif(F.col("p_type"), F.lit("PROMO")).alias("p_type"))
    return stats.count_by_type(parts, "p_type")


@query("q_completeness", f"""WITH {LABELLED_SQL} SELECT COUNT(*) AS rows,
  COUNT(*) FILTER (lang <> '' AND source <> '' AND quality IS NOT NULL AND toxic IS NOT NULL) AS complete,
  COUNT(*) FILTER (lang IS NULL OR lang = '') AS missing_lang,
  COUNT(*) FILTER (source IS NULL OR source = '') AS missing_source,
  COUNT(*) FILTER (quality IS NULL) AS missing_quality,
  COUNT(*) FILTER (toxic IS NULL) AS missing_toxic,
  ROUND(100.0 * COUNT(*) FILTER (lang <> '' AND source <> '' AND quality IS NOT NULL
    AND toxic IS NOT NULL) / COUNT(*), 4) AS complete_percent FROM labelled""")
def completeness(spark, sf_dir):
    return stats.completeness(labelled_documents(spark, sf_dir), ["lang", "source", "quality", "toxic"])


SYNC_STATS_SQL = """COUNT(*) AS total_syncs, COUNT(*) FILTER (is_success) AS successful_syncs,
  CAST(SUM(synced_count) AS BIGINT) AS total_issues_synced,
  ROUND(AVG((EPOCH_US(end_time) - EPOCH_US(start_time)) // 1000 / 1000.0), 6) AS average_duration_seconds,
  ARG_MAX(end_time, run_id) AS last_sync_time,
  ARG_MAX(end_time, run_id) FILTER (is_success) AS last_successful_sync_time"""


@query("q_a16", f"WITH {RUNS_SQL} SELECT service, {SYNC_STATS_SQL} FROM runs GROUP BY service")
def a16(spark, sf_dir):
    return stats.sync_stats(runs(spark, sf_dir), ["service"])


@query("q_project_sync", f"""
WITH {ISSUES_SQL},
known AS (SELECT DISTINCT reporter_display_name FROM issues WHERE created < TIMESTAMP '2000-01-01'),
fetched AS (SELECT i.*, k.reporter_display_name IS NOT NULL AS is_known
  FROM issues i LEFT JOIN known k ON i.reporter_display_name = k.reporter_display_name
  WHERE updated >= TIMESTAMP '2001-01-01'),
failed AS (SELECT DISTINCT project_key FROM issues
  WHERE project_key = 'FURNITURE' AND status_name = 'P')
SELECT project_key, COUNT(*) AS synced_count, COUNT(*) FILTER (NOT is_known) AS new_count,
  COUNT(*) FILTER (is_known) AS updated_count, CAST(0 AS BIGINT) AS error_count,
  TIMESTAMP '2001-08-01' AS last_sync_time
FROM fetched WHERE project_key IS NOT NULL AND project_key NOT IN (SELECT project_key FROM failed)
GROUP BY project_key
UNION ALL SELECT project_key, 0, 0, 0, 1, TIMESTAMP '2001-08-01' FROM failed""")
def project_sync(spark, sf_dir):
    everything = issues(spark, sf_dir)
    known = owned_issues(spark, sf_dir).where(F.col("created") < instant("2000-01-01"))
    fetched = everything.where(F.col("updated") >= instant("2001-01-01"))
    failed = owned_issues(spark, sf_dir).where(
        (F.col("project_key") == "FURNITURE") & (F.col("status_name") == "P")
    )
    marked = classify(fetched, known, "reporter_display_name")
    return project_rollup(marked, ORDERS_AS_OF, failed.select("project_key"))


@query("q_distinct", f"WITH {OWNED_SQL} SELECT DISTINCT project_key, status_name FROM owned_issues")
def distinct(spark, sf_dir):
    return stats.distinct_values(owned_issues(spark, sf_dir), "project_key", "status_name")


@query("q_field_profile", """
SELECT 'k' AS field, CASE JSON_TYPE(props, '$.k') WHEN 'VARCHAR' THEN 'String' WHEN 'BOOLEAN' THEN 'Boolean'
  WHEN 'ARRAY' THEN 'Array' WHEN 'OBJECT' THEN 'Object' WHEN 'NULL' THEN 'null' ELSE 'Number' END AS json_type,
  COUNT(*) AS n FROM events WHERE JSON_EXISTS(props, '$.k') GROUP BY 1, 2""")
def field_profile(spark, sf_dir):
    return stats.field_profile(table(spark, sf_dir, "events"), "props")


@query("q_project_history_stats", f"""WITH {OWNED_SQL}, {HISTORY_SQL}
SELECT project_key, CASE WHEN field_name = 'status' THEN 'Status Changes' WHEN field_name = 'assignee' THEN 'Assignee Changes'
    WHEN field_name = 'priority' THEN 'Priority Changes' WHEN field_id IS NOT NULL THEN 'Custom Field Changes'
    ELSE 'Other Changes' END AS change_group,
  COUNT(*) AS changes, MIN(change_timestamp) AS first_change, MAX(change_timestamp) AS last_change
FROM history JOIN owned_issues i ON issue_id = i.id
WHERE project_key IS NOT NULL AND change_timestamp BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31'
GROUP BY 1, 2""")
def project_history_stats(spark, sf_dir):
    """Read from the stored history, of which the span's months are enough."""
    path = scratch_path(spark, "history")
    overwrite_history(history(spark, sf_dir), path)
    return stats.project_history_stats(
        spark.read.parquet(path), owned_issues(spark, sf_dir), DateRange("1997-01-01", "1999-12-31")
    )


@query("q_project_top_authors", f"""WITH {OWNED_SQL}, {HISTORY_SQL}
SELECT author_account_id, COUNT(*) AS changes, COUNT(DISTINCT h.issue_key) AS issues
FROM history h JOIN owned_issues i ON issue_id = i.id WHERE project_key = 'BUILDING'
GROUP BY author_account_id ORDER BY changes DESC, author_account_id LIMIT 20""")
def project_top_authors(spark, sf_dir):
    return stats.top_authors_of(history(spark, sf_dir), owned_issues(spark, sf_dir), "BUILDING", 20)


@query("q_top_authors", f"""WITH {HISTORY_SQL} SELECT author_account_id, COUNT(*) AS changes,
  COUNT(DISTINCT issue_key) AS issues FROM history
WHERE change_timestamp BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31'
GROUP BY author_account_id ORDER BY changes DESC, author_account_id LIMIT 20""")
def top_authors(spark, sf_dir):
    return stats.top_authors(history(spark, sf_dir), 20, DateRange("1997-01-01", "1999-12-31"))


@query("q_n3", f"""WITH {HISTORY_SQL} SELECT author_account_id,
  COUNT(*) FILTER (field_name = 'status') AS status_changes,
  COUNT(*) FILTER (field_name = 'priority') AS priority_changes,
  COUNT(*) FILTER (field_name = 'Sprint' AND field_id IS NOT NULL) AS custom_changes
FROM history GROUP BY author_account_id""")
def n3(spark, sf_dir):
    counted = stats.change_type_map(history(spark, sf_dir), "author_account_id")
    return counted.select(
        "author_account_id",
        F.element_at("changes", "StatusChange").alias("status_changes"),
        F.element_at("changes", "PriorityChange").alias("priority_changes"),
        F.element_at("changes", "CustomField").alias("custom_changes"),
    )
