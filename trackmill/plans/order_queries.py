"""Queries of the sort, paging and per-group families."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions.instants import instant
from trackmill.operators.grouping import (
    first_by_text,
    first_seen,
    last_wins,
    latest_per_project,
    retain_last,
    timeline,
    timeline_gaps,
)
from trackmill.operators.filters import HistoryFilter, IssueFilter
from trackmill.operators.ordering import (
    assign_pages,
    issue_order,
    latest,
    load_history,
    load_issues,
    numbered,
    page_after,
    take_page,
)
from trackmill.operators.setops import concat
from trackmill.operators.upsert import delete_keys, deleted_rows, duplicate_keys, upsert
from trackmill.plans.join_queries import FIRST_SQL, SECOND_SQL, landings
from trackmill.plans.registry import query
from trackmill.plans.standins import (
    HISTORY_SQL,
    HISTORY_TIES,
    ISSUES_SQL,
    OWNED_SQL,
    RUNS_SQL,
    history,
    issues,
    owned_issues,
    runs,
    table,
)

SHOWN = ("id", "issue_key", "priority_name", "created")
SHOWN_SQL = ", ".join(SHOWN)


def _sorted_query(name: str, sort_order: str, order_sql: str, with_updates: bool = False) -> None:
    """A whole order, checked by the position each row comes out at."""
    view, sql = (issues, ISSUES_SQL) if with_updates else (owned_issues, OWNED_SQL)
    source = "issues" if with_updates else "owned_issues"
    shown = (*SHOWN, "updated") if with_updates else SHOWN

    @query(name, f"""WITH {sql} SELECT {', '.join(shown)},
      ROW_NUMBER() OVER (ORDER BY {order_sql}) AS position FROM {source}""")
    def run(spark, sf_dir):
        return numbered(load_issues(view(spark, sf_dir), IssueFilter(sort_order=sort_order)).select(*shown))


_sorted_query("q_o1", "created_asc", "created, issue_key, id")
_sorted_query("q_o2", "created_desc", "created DESC, issue_key, id")
_sorted_query("q_o3", "updated_asc", "updated, issue_key, id", with_updates=True)
_sorted_query("q_o4", "updated_desc", "updated DESC, issue_key, id", with_updates=True)
_sorted_query("q_o5", "key_asc", "issue_key, id")
_sorted_query("q_o6", "key_desc", "issue_key DESC, id")
_sorted_query("q_sort_priority", "priority_asc", "priority_name NULLS LAST, issue_key, id")
_sorted_query("q_o8", "priority_desc", "priority_name DESC NULLS LAST, issue_key, id")

RANKS = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 4}


@query("q_o7", f"""WITH {OWNED_SQL} SELECT {SHOWN_SQL} FROM owned_issues
ORDER BY CASE priority_name WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
  WHEN '5-LOW' THEN 4 END DESC NULLS LAST, issue_key, id LIMIT 200""")
def o7(spark, sf_dir):
    order = issue_order("priority_desc", RANKS)
    return take_page(owned_issues(spark, sf_dir), order, limit=200).select(*SHOWN)


def _sorted_history_query(name: str, sort_order: str, order_sql: str) -> None:
    @query(name, f"""WITH {HISTORY_SQL} SELECT issue_key, change_id, field_name, change_timestamp,
      ROW_NUMBER() OVER (ORDER BY {order_sql}) AS position FROM history""")
    def run(spark, sf_dir):
        ordered = load_history(history(spark, sf_dir), HistoryFilter(sort_order=sort_order), HISTORY_TIES)
        return numbered(ordered.select("issue_key", "change_id", "field_name", "change_timestamp"))


_sorted_history_query("q_o9", "timestamp_desc", "change_timestamp DESC, issue_key, change_id, field_name")
_sorted_history_query("q_o9_oldest", "timestamp_asc", "change_timestamp, issue_key, change_id, field_name")
_sorted_history_query("q_o9_key", "issue_key", "issue_key, change_id, field_name")
_sorted_history_query("q_o9_field", "field_name", "field_name, issue_key, change_id")


@query("q_topk", f"""WITH {OWNED_SQL} SELECT {SHOWN_SQL} FROM owned_issues
WHERE project_key IN ('MACHINERY', 'BUILDING') ORDER BY created DESC, issue_key, id LIMIT 50""")
def topk(spark, sf_dir):
    spec = IssueFilter(project_keys=["MACHINERY", "BUILDING"], limit=50)
    return load_issues(owned_issues(spark, sf_dir), spec).select(*SHOWN)


@query("q_page", f"""WITH {OWNED_SQL} SELECT {SHOWN_SQL} FROM owned_issues
ORDER BY created DESC, issue_key, id LIMIT 50 OFFSET 100""")
def page(spark, sf_dir):
    return load_issues(owned_issues(spark, sf_dir), IssueFilter(limit=50, offset=100)).select(*SHOWN)


@query("q_o11", f"""WITH {OWNED_SQL} SELECT {SHOWN_SQL} FROM owned_issues
ORDER BY created, issue_key, id OFFSET 400""")
def o11(spark, sf_dir):
    spec = IssueFilter(sort_order="created_asc", offset=400)
    return load_issues(owned_issues(spark, sf_dir).select(*SHOWN), spec, positions=True)


@query("q_o12", f"""WITH {OWNED_SQL}, numbered AS (
  SELECT id, ROW_NUMBER() OVER (ORDER BY created, issue_key, id) AS position FROM owned_issues)
SELECT id, position, (position - 1) // 1000 AS page FROM numbered""")
def o12(spark, sf_dir):
    shown = owned_issues(spark, sf_dir).select("id", "issue_key", "created")
    return assign_pages(shown, issue_order("created_asc"), 1000).select("id", "position", "page")


@query("q_page_after", f"""WITH {OWNED_SQL} SELECT {SHOWN_SQL} FROM owned_issues
WHERE created > TIMESTAMP '1998-01-01'
   OR (created = TIMESTAMP '1998-01-01' AND issue_key > 'BUILDING-9')
ORDER BY created, issue_key, id LIMIT 1000""")
def next_page(spark, sf_dir):
    return page_after(owned_issues(spark, sf_dir), "1998-01-01", "BUILDING-9", 1000).select(*SHOWN)


@query("q_latest", "SELECT event_id, user_id, event_type, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_event(spark, sf_dir):
    found = latest(table(spark, sf_dir, "events"), "ts", ["event_id"])
    return found.select("event_id", "user_id", "event_type", "ts")


# --- per group ---------------------------------------------------------------


@query("q_dedup_first", f"""SELECT event_id, ts, landing FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY landing, ts) AS place FROM (
    SELECT *, 1 AS landing FROM ({FIRST_SQL}) UNION ALL SELECT *, 2 FROM ({SECOND_SQL})))
WHERE place = 1""")
def dedup_first(spark, sf_dir):
    first, second = landings(spark, sf_dir)
    landed = concat([first.withColumn("landing", F.lit(1)), second.withColumn("landing", F.lit(2))])
    kept = first_seen(landed, ["event_id"], [F.col("landing"), F.col("ts")])
    return kept.select("event_id", "ts", "landing")


@query("q_w1", "SELECT MIN(doc_id) AS doc_id, ARG_MIN(source, doc_id) AS source FROM documents GROUP BY text")
def w1(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return first_by_text(documents, "text", [F.col("doc_id")]).select("doc_id", "source")


@query("q_w2", """SELECT user_id, ARG_MAX(event_id, event_id) AS event_id,
  ARG_MAX(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def w2(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return last_wins(events, ["user_id"], [F.col("event_id").desc()])


@query("q_retain_last_n", f"""WITH {RUNS_SQL} SELECT service, run_id, end_time, synced_count, is_success
FROM runs QUALIFY ROW_NUMBER() OVER (PARTITION BY service ORDER BY run_id DESC) <= 5""")
def retain(spark, sf_dir):
    kept = retain_last(runs(spark, sf_dir), "service", [F.col("run_id").desc()], 5)
    return kept.select("service", "run_id", "end_time", "synced_count", "is_success")


@query("q_top_per_project", f"""WITH {OWNED_SQL} SELECT project_key, issue_key, created
FROM owned_issues WHERE project_key IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY project_key ORDER BY created DESC, issue_key, id) <= 3""")
def top_per_project(spark, sf_dir):
    return latest_per_project(owned_issues(spark, sf_dir)).select("project_key", "issue_key", "created")


@query("q_timeline", f"""WITH {HISTORY_SQL} SELECT issue_key, change_timestamp, change_id,
  field_name, from_display_value, to_display_value,
  ROW_NUMBER() OVER (ORDER BY issue_key, change_timestamp, change_id, field_name) AS position FROM history""")
def issue_timeline(spark, sf_dir):
    return numbered(timeline(history(spark, sf_dir), ["change_id", "field_name"]).select(
        "issue_key", "change_timestamp", "change_id", "field_name", "from_display_value", "to_display_value"
    ))


@query("q_w5_gaps", f"""WITH {HISTORY_SQL}, chained AS (
  SELECT *, LAG(to_display_value) OVER w AS expected, ROW_NUMBER() OVER w AS place
  FROM history WINDOW w AS (PARTITION BY issue_key, field_name ORDER BY change_timestamp, change_id))
SELECT issue_key, field_name, change_timestamp, change_id, from_display_value, expected FROM chained
WHERE place > 1 AND expected IS DISTINCT FROM from_display_value""")
def timeline_breaks(spark, sf_dir):
    return timeline_gaps(history(spark, sf_dir), ["change_id"]).select(
        "issue_key", "field_name", "change_timestamp", "change_id", "from_display_value", "expected"
    )


# --- upsert and delete -------------------------------------------------------


@query("q_upsert_latest", """
WITH target AS (
  SELECT user_id AS id, MAX_BY(event_type, event_id) AS status_name, MAX_BY(ts, event_id) AS updated
  FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY user_id),
incoming AS (
  SELECT user_id AS id, MAX_BY(event_type, event_id) AS status_name, MAX_BY(ts, event_id) AS updated
  FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_type <> 'view' GROUP BY user_id)
SELECT * FROM incoming
UNION ALL SELECT * FROM target WHERE id NOT IN (SELECT id FROM incoming)""")
def upsert_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), "event_id", F.col("event_type").alias("status_name"),
        F.col("ts").alias("updated"),
    )
    newest = [F.col("event_id").desc()]
    target = last_wins(events.where(F.col("updated") < instant("2024-01-16")), ["id"], newest)
    incoming = events.where(
        (F.col("updated") >= instant("2024-01-16")) & (F.col("status_name") != "view")
    )
    return upsert(target, incoming, "id", newest).select("id", "status_name", "updated")


@query("q_delete_by_key", f"""WITH {OWNED_SQL} SELECT {SHOWN_SQL} FROM owned_issues
WHERE reporter_display_name NOT IN (SELECT c_name FROM customer WHERE c_acctbal < 0)""")
def delete_by_key(spark, sf_dir):
    closed = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    keys = closed.select(F.col("c_name").alias("reporter_display_name"))
    return delete_keys(owned_issues(spark, sf_dir), keys, "reporter_display_name").select(*SHOWN)


@query("q_s7", """SELECT COUNT(*) AS deleted FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def s7(spark, sf_dir):
    closed = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    keys = closed.select(F.col("c_custkey").alias("o_custkey"))
    removed = deleted_rows(table(spark, sf_dir, "orders"), keys, "o_custkey")
    return removed.agg(F.count("*").alias("deleted"))


@query("q_delete_history", f"""WITH {HISTORY_SQL} SELECT issue_key, change_id, change_timestamp
FROM history WHERE issue_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P')""")
def delete_history(spark, sf_dir):
    pending = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    keys = pending.select(F.concat(F.lit("ORD-"), "o_orderkey").alias("issue_key"))
    kept = delete_keys(history(spark, sf_dir), keys)
    return kept.select("issue_key", "change_id", "change_timestamp")


@query("q_duplicate_keys", """SELECT text_hash, COUNT(*) AS ids FROM (
  SELECT DISTINCT MD5(text) AS text_hash, doc_id FROM documents) GROUP BY text_hash HAVING COUNT(*) > 1""")
def duplicated(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(F.md5("text").alias("text_hash"), "doc_id")
    return duplicate_keys(documents, "text_hash", "doc_id")
