"""Queries of the projection and scalar-function family."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions.changes import author_struct, change_sentence, change_type, flat_author
from trackmill.functions.instants import elapsed_hours, elapsed_seconds, minute_text, parse_instant, parse_minute
from trackmill.functions.projections import light, percent, select_fields, without_fields
from trackmill.functions.text import decoded_text, or_default, preview
from trackmill.plans.registry import query
from trackmill.plans.standins import (
    HISTORY_SQL,
    ISSUES_SQL,
    OWNED_SQL,
    RUNS_SQL,
    document_issues,
    history,
    issue_documents,
    issues,
    owned_issues,
    runs,
    table,
)
from trackmill.sources.landing import flatten_issues, with_custom_fields

CHANGE_TYPE_SQL = """CASE field_name WHEN 'status' THEN 'StatusChange'
  WHEN 'assignee' THEN 'AssigneeChange' WHEN 'priority' THEN 'PriorityChange'
  ELSE CASE WHEN field_id IS NOT NULL THEN 'CustomField' ELSE 'FieldUpdate' END END"""


@query("q_change_type", f"WITH {HISTORY_SQL} SELECT issue_key, change_id, field_name, "
       f"{CHANGE_TYPE_SQL} AS change_type FROM history")
def change_types(spark, sf_dir):
    kinds = history(spark, sf_dir).withColumn("change_type", change_type())
    return kinds.select("issue_key", "change_id", "field_name", "change_type")


@query("q_change_summary", f"""WITH {HISTORY_SQL} SELECT issue_key, change_id,
  STRFTIME(change_timestamp, '%Y-%m-%d %H:%M:%S') || ': '
  || COALESCE(author_display_name, 'System') || ' changed ' || field_name || ' from '''
  || COALESCE(from_display_value, 'None') || ''' to '''
  || COALESCE(to_display_value, 'None') || '''' AS change_summary FROM history""")
def change_summary(spark, sf_dir):
    return history(spark, sf_dir).select("issue_key", "change_id", change_sentence().alias("change_summary"))


@query("q_c3", f"""WITH {OWNED_SQL} SELECT issue_key, summary, status_name, priority_name, created
FROM owned_issues""")
def c3(spark, sf_dir):
    return select_fields(owned_issues(spark, sf_dir), ["key", "summary", "status", "priority", "created"])


@query("q_project_fields", f"""WITH {ISSUES_SQL} SELECT issue_key, status_name, priority_name,
  issue_type_name, created, updated FROM issues""")
def project_fields(spark, sf_dir):
    return without_fields(issues(spark, sf_dir), ["summary", "reporter"])


@query("q_custom_fields", f"""WITH {ISSUES_SQL}
SELECT id, 'customfield_10001' AS field, CAST(LENGTH(summary) AS VARCHAR) AS value
FROM issues SEMI JOIN last_change ON id = change_of
UNION ALL
SELECT id, 'customfield_10002', '{{"value":"' || issue_type_name || '"}}'
FROM issues SEMI JOIN last_change ON id = change_of
UNION ALL
SELECT id, 'labels', '["' || LOWER(status_name) || '","' || LOWER(issue_type_name) || '"]'
FROM issues SEMI JOIN last_change ON id = change_of""")
def custom(spark, sf_dir):
    found = with_custom_fields(flatten_issues(issue_documents(spark, sf_dir)))
    return found.select("id", F.explode("custom_fields").alias("field", "value"))


@query("q_c6", f"WITH {OWNED_SQL} SELECT id, issue_key, summary FROM owned_issues")
def c6(spark, sf_dir):
    return light(owned_issues(spark, sf_dir))


@query("q_preview", "SELECT doc_id AS id, SUBSTRING(text, 1, 50) AS preview FROM documents")
def text_preview(spark, sf_dir):
    return document_issues(spark, sf_dir).select("id", preview(F.col("description"), 50).alias("preview"))


@query("q_c8", """SELECT event_id, ts - INTERVAL 9 HOUR AS east, ts AS zulu,
  CAST(NULL AS TIMESTAMP) AS bad FROM events""")
def c8(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")

    def parsed(offset):
        return parse_instant(F.concat(text, F.lit(offset))).cast("timestamp_ntz")

    return table(spark, sf_dir, "events").select(
        "event_id", parsed("+0900").alias("east"), parsed("Z").alias("zulu"), parsed("").alias("bad")
    )


@query("q_minute_roundtrip", """SELECT event_id, STRFTIME(ts, '%Y-%m-%d %H:%M') AS minute_text,
  DATE_TRUNC('minute', ts) AS minute FROM events""")
def minute_roundtrip(spark, sf_dir):
    formatted = table(spark, sf_dir, "events").select("event_id", minute_text(F.col("ts")).alias("minute_text"))
    return formatted.withColumn("minute", parse_minute(F.col("minute_text")))


@query("q_c10", f"""WITH {OWNED_SQL} SELECT id, CASE WHEN status_name = 'O'
  THEN '{{"text":"' || summary || '","type":"doc"}}' ELSE 'About ' || summary END AS description_text
FROM owned_issues""")
def c10(spark, sf_dir):
    parsed = issue_documents(spark, sf_dir).select(F.try_parse_json("raw_json").alias("doc"))
    return parsed.select(
        F.try_variant_get("doc", "$.id", "string").alias("id"),
        decoded_text(F.try_variant_get("doc", "$.fields.description", "variant")).alias("description_text"),
    )


@query("q_c11", f"""WITH {HISTORY_SQL} SELECT issue_key, change_id,
  COALESCE(author_display_name, 'System') AS author, COALESCE(from_display_value, 'None') AS before
FROM history""")
def c11(spark, sf_dir):
    return history(spark, sf_dir).select(
        "issue_key", "change_id", or_default(F.col("author_display_name"), "System").alias("author"),
        or_default(F.col("from_display_value"), "None").alias("before"),
    )


@query("q_c12", f"""WITH {RUNS_SQL} SELECT service, run_id,
  (EPOCH_US(end_time) - EPOCH_US(start_time)) // 1000000 AS seconds,
  ROUND((EPOCH_US(end_time) - EPOCH_US(start_time)) // 1000000 / 3600.0, 6) AS hours FROM runs""")
def c12(spark, sf_dir):
    start, end = F.col("start_time"), F.col("end_time")
    return runs(spark, sf_dir).select(
        "service", "run_id", elapsed_seconds(start, end).alias("seconds"),
        F.round(elapsed_hours(start, end), 6).alias("hours"),
    )


@query("q_c13", f"""WITH {RUNS_SQL} SELECT service,
  ROUND(100.0 * COUNT(*) FILTER (is_success) / COUNT(*), 4) AS success_rate
FROM runs GROUP BY service""")
def c13(spark, sf_dir):
    rate = percent(F.count_if("is_success"), F.count("*"))
    return runs(spark, sf_dir).groupBy("service").agg(F.round(rate, 4).alias("success_rate"))


@query("q_n2", f"""WITH {HISTORY_SQL} SELECT issue_key, change_id,
  CASE WHEN author_display_name IS NOT NULL THEN author_account_id END AS author_account_id,
  author_display_name, CAST(NULL AS VARCHAR) AS author_email FROM history""")
def n2(spark, sf_dir):
    assembled = history(spark, sf_dir).select("issue_key", "change_id", author_struct().alias("author"))
    return assembled.select("issue_key", "change_id", *flat_author())
