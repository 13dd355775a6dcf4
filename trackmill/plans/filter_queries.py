"""Queries of the predicate family."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions.text import contains_any
from trackmill.operators.filters import (
    DateRange,
    HistoryFilter,
    IssueFilter,
    TimeWindow,
    in_chunk,
    of_type_not_in_status,
    open_issues,
    updated_within,
)
from trackmill.operators.ordering import load_history, load_issues, numbered
from trackmill.plans.registry import query
from trackmill.plans.standins import (
    FLAT_SQL,
    HISTORY_SQL,
    HISTORY_TIES,
    ISSUES_SQL,
    LABELLED_SQL,
    ORDERS_AS_OF,
    OWNED_SQL,
    document_issues,
    flat_issues,
    history,
    issue_documents,
    issues,
    labelled_documents,
    owned_issues,
    part_issues,
)
from trackmill.session import scratch_path
from trackmill.sources.landing import flatten_issues
from trackmill.sources.tables import CREATED_DATE, overwrite_history, save_issues

BRIEF = ("id", "issue_key", "project_key", "status_name", "created")
BRIEF_SQL = ", ".join(BRIEF)


@query("q_f1", f"WITH {OWNED_SQL} SELECT {BRIEF_SQL} FROM owned_issues "
       "WHERE project_key IN ('BUILDING', 'MACHINERY')")
def f1(spark, sf_dir):
    spec = IssueFilter(project_keys=["BUILDING", "MACHINERY"])
    return spec.apply(owned_issues(spark, sf_dir)).select(*BRIEF)


@query("q_f2", f"WITH {FLAT_SQL} SELECT id, status_name, created FROM flat_issues "
       "WHERE status_name IN ('O', 'P')")
def f2(spark, sf_dir):
    return IssueFilter(statuses=["O", "P"]).apply(flat_issues(spark, sf_dir)).select("id", "status_name", "created")


@query("q_f3", f"WITH {FLAT_SQL} SELECT id, priority_name FROM flat_issues "
       "WHERE priority_name IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')")
def f3(spark, sf_dir):
    spec = IssueFilter(priorities=["1-URGENT", "2-HIGH", "4-NOT SPECIFIED"])
    return spec.apply(flat_issues(spark, sf_dir)).select("id", "priority_name")


@query("q_f4", f"WITH {FLAT_SQL} SELECT id, issue_type_name FROM flat_issues "
       "WHERE issue_type_name = 'Epic'")
def f4(spark, sf_dir):
    return IssueFilter(issue_types=["Epic"]).apply(flat_issues(spark, sf_dir)).select("id", "issue_type_name")


PEOPLE = ["Customer#000000001", "Customer#000000037", "Customer#000000101", "Customer#000000149"]
PEOPLE_SQL = ", ".join(f"'{name}'" for name in PEOPLE)


@query("q_f5", f"WITH {OWNED_SQL} SELECT {BRIEF_SQL}, reporter_display_name FROM owned_issues "
       f"WHERE reporter_display_name IN ({PEOPLE_SQL})")
def f5(spark, sf_dir):
    found = IssueFilter(reporters=PEOPLE).apply(owned_issues(spark, sf_dir))
    return found.select(*BRIEF, "reporter_display_name")


@query("q_f6", f"WITH {OWNED_SQL} SELECT {BRIEF_SQL}, assignee_display_name FROM owned_issues "
       f"WHERE assignee_display_name IN ({PEOPLE_SQL})")
def f6(spark, sf_dir):
    found = IssueFilter(assignees=PEOPLE).apply(owned_issues(spark, sf_dir))
    return found.select(*BRIEF, "assignee_display_name")


@query("q_f7", f"WITH {FLAT_SQL} SELECT id, created FROM flat_issues WHERE created BETWEEN "
       "TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30'")
def f7(spark, sf_dir):
    spec = IssueFilter(created_range=DateRange("1997-01-01", "1997-06-30"))
    return spec.apply(flat_issues(spark, sf_dir)).select("id", "created")


@query("q_f8", f"WITH {ISSUES_SQL} SELECT id, created, updated FROM issues WHERE updated BETWEEN "
       "TIMESTAMP '2001-01-01' AND TIMESTAMP '2001-03-31'")
def f8(spark, sf_dir):
    spec = IssueFilter(updated_range=DateRange("2001-01-01", "2001-03-31"))
    return spec.apply(issues(spark, sf_dir)).select("id", "created", "updated")


@query("q_f9", "SELECT p_partkey AS id, p_name AS summary FROM part "
       "WHERE CONTAINS(LOWER(p_name), 'ring')")
def f9(spark, sf_dir):
    return IssueFilter(summary_contains="RING").apply(part_issues(spark, sf_dir)).select("id", "summary")


@query("q_f10", "SELECT doc_id AS id, source AS project_key FROM documents "
       "WHERE CONTAINS(LOWER(text), 'est the')")
def f10(spark, sf_dir):
    spec = IssueFilter(description_contains="Est The")
    return spec.apply(document_issues(spark, sf_dir)).select("id", "project_key")


@query("q_f11", f"WITH {LABELLED_SQL} SELECT id, lang FROM labelled WHERE lang = 'fr' OR toxic = 1")
def f11(spark, sf_dir):
    flags = F.array(
        F.col("lang"), F.when(F.col("quality") == 1, "quality"), F.when(F.col("toxic") == 1, "toxic")
    )
    labelled = labelled_documents(spark, sf_dir).withColumn("labels", F.array_compact(flags))
    return IssueFilter(labels=["toxic", "fr"]).apply(labelled).select("id", "lang")


@query("q_f11_documents", f"""WITH {ISSUES_SQL} SELECT id, status_name FROM issues
WHERE id IN (SELECT change_of FROM last_change) AND (status_name = 'P' OR issue_type_name = 'Epic')""")
def f11_documents(spark, sf_dir):
    """Labels as landed issue documents carry them."""
    found = IssueFilter(labels=["p", "epic"]).apply(flatten_issues(issue_documents(spark, sf_dir)))
    return found.select("id", "status_name")


@query("q_f7_stored", f"WITH {FLAT_SQL} SELECT id, created FROM flat_issues WHERE created BETWEEN "
       "TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-02-28'")
def f7_stored(spark, sf_dir):
    """The same range over issues stored by the date they were created."""
    path = scratch_path(spark, "issues")
    save_issues(flat_issues(spark, sf_dir), path)
    spec = IssueFilter(created_range=DateRange("1997-01-01", "1997-02-28"))
    return spec.apply(spark.read.parquet(path), CREATED_DATE).select("id", "created")


@query("q_f17_stored", f"""WITH {HISTORY_SQL} SELECT issue_key, change_id, change_timestamp FROM history
WHERE change_timestamp BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-31'""")
def f17_stored(spark, sf_dir):
    """A range over stored history, of which one month is read."""
    path = scratch_path(spark, "history")
    overwrite_history(history(spark, sf_dir), path)
    spec = HistoryFilter(date_range=DateRange("1998-03-01", "1998-03-31"))
    return spec.apply(spark.read.parquet(path)).select("issue_key", "change_id", "change_timestamp")


@query("q_filter_combo", f"""
WITH {ISSUES_SQL} SELECT {BRIEF_SQL}, priority_name, updated FROM issues
WHERE project_key IN ('AUTOMOBILE', 'BUILDING') AND status_name IN ('O', 'P')
  AND priority_name IN ('1-URGENT', '2-HIGH') AND issue_type_name IN ('Epic', 'Story')
  AND assignee_display_name IS NOT NULL
  AND created BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'
  AND updated BETWEEN TIMESTAMP '1996-06-01' AND TIMESTAMP '2001-06-30'
  AND CONTAINS(LOWER(summary), 'customer#0000')""")
def filter_combo(spark, sf_dir):
    spec = IssueFilter(
        project_keys=["AUTOMOBILE", "BUILDING"], statuses=["O", "P"],
        priorities=["1-URGENT", "2-HIGH"], issue_types=["Epic", "Story"],
        created_range=DateRange("1996-01-01", "1999-12-31"),
        updated_range=DateRange("1996-06-01", "2001-06-30"), summary_contains="CUSTOMER#0000",
    )
    assigned = issues(spark, sf_dir).where(F.col("assignee_display_name").isNotNull())
    return load_issues(assigned, spec).select(*BRIEF, "priority_name", "updated")


@query("q_last_days", f"WITH {FLAT_SQL} SELECT id, created FROM flat_issues WHERE created BETWEEN "
       "TIMESTAMP '2001-08-01' - INTERVAL 90 DAY AND TIMESTAMP '2001-08-01'")
def last_days(spark, sf_dir):
    span = DateRange.last_days(90, ORDERS_AS_OF).validate()
    return IssueFilter(created_range=span).apply(flat_issues(spark, sf_dir)).select("id", "created")


CHANGE = ("issue_key", "change_id", "change_timestamp", "field_name", "to_display_value")
CHANGE_SQL = ", ".join(CHANGE)


@query("q_f14", f"WITH {HISTORY_SQL} SELECT {CHANGE_SQL} FROM history "
       "WHERE issue_key IN ('ORD-7', 'ORD-32', 'ORD-519', 'ORD-1000')")
def f14(spark, sf_dir):
    spec = HistoryFilter(issue_keys=["ORD-7", "ORD-32", "ORD-519", "ORD-1000"])
    return load_history(history(spark, sf_dir), spec, HISTORY_TIES).select(*CHANGE)


@query("q_field_changes", f"WITH {HISTORY_SQL} SELECT {CHANGE_SQL} FROM history "
       "WHERE field_name IN ('status', 'Sprint')")
def field_changes(spark, sf_dir):
    return HistoryFilter(field_names=["status", "Sprint"]).apply(history(spark, sf_dir)).select(*CHANGE)


@query("q_f16", f"WITH {HISTORY_SQL} SELECT {CHANGE_SQL}, author_account_id FROM history "
       "WHERE author_account_id IN ('S1', 'S5', 'S9')")
def f16(spark, sf_dir):
    spec = HistoryFilter(authors=["S1", "S5", "S9"])
    return load_history(history(spark, sf_dir), spec, HISTORY_TIES).select(*CHANGE, "author_account_id")


@query("q_f17", f"WITH {HISTORY_SQL} SELECT {CHANGE_SQL} FROM history WHERE change_timestamp "
       "BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-31'")
def f17(spark, sf_dir):
    spec = HistoryFilter(date_range=DateRange("1998-03-01", "1998-03-31"))
    return load_history(history(spark, sf_dir), spec, HISTORY_TIES).select(*CHANGE)


@query("q_f18", f"""WITH {HISTORY_SQL} SELECT {CHANGE_SQL}, field_id FROM history
WHERE field_name = 'assignee' OR (field_name = 'Sprint' AND field_id IS NOT NULL)""")
def f18(spark, sf_dir):
    spec = HistoryFilter(change_types=["AssigneeChange", "CustomField"])
    return spec.apply(history(spark, sf_dir)).select(*CHANGE, "field_id")


@query("q_f19", f"""WITH {HISTORY_SQL} SELECT {CHANGE_SQL} FROM history
WHERE change_timestamp BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31'
ORDER BY change_timestamp DESC, issue_key, change_id, field_name LIMIT 250""")
def f19(spark, sf_dir):
    spec = HistoryFilter(date_range=DateRange("1999-01-01", "1999-12-31"), limit=250)
    return load_history(history(spark, sf_dir), spec, HISTORY_TIES).select(*CHANGE)


@query("q_time_window", f"""WITH {ISSUES_SQL} SELECT id, created, updated FROM issues
WHERE created BETWEEN TIMESTAMP '1999-02-01' AND TIMESTAMP '1999-03-01'
   OR updated BETWEEN TIMESTAMP '1999-02-01' AND TIMESTAMP '1999-03-01'""")
def time_window(spark, sf_dir):
    window = TimeWindow.dates("1999-02-01", "1999-03-01")
    return window.apply(issues(spark, sf_dir)).select("id", "created", "updated")


@query("q_f21", f"""
WITH {ISSUES_SQL}, spans(preset, since, until) AS (VALUES
  ('last_hours', TIMESTAMP '2001-07-30', TIMESTAMP '2001-08-01'),
  ('last_days', TIMESTAMP '2001-07-02', TIMESTAMP '2001-08-01'),
  ('dates', TIMESTAMP '2000-01-01', TIMESTAMP '2000-06-30'),
  ('incremental', TIMESTAMP '2001-07-15', TIMESTAMP '2001-08-01'))
SELECT preset, COUNT(*) AS n FROM issues JOIN spans
  ON created BETWEEN since AND until OR updated BETWEEN since AND until GROUP BY preset""")
def f21(spark, sf_dir):
    presets = {
        "last_hours": TimeWindow.last_hours(48, ORDERS_AS_OF),
        "last_days": TimeWindow.last_days(30, ORDERS_AS_OF),
        "dates": TimeWindow.dates("2000-01-01", "2000-06-30"),
        "incremental": TimeWindow.incremental_since("2001-07-15", ORDERS_AS_OF),
    }
    hits = F.array_compact(F.array(*[F.when(w.condition(), name) for name, w in presets.items()]))
    marked = issues(spark, sf_dir).select(F.explode(hits).alias("preset"))
    return marked.groupBy("preset").agg(F.count("*").alias("n"))


@query("q_f22", f"""WITH {ISSUES_SQL} SELECT id, updated FROM issues
WHERE updated >= TIMESTAMP '2001-05-01'""")
def f22(spark, sf_dir):
    window = TimeWindow(since="2001-05-01", by_created=False)
    return window.apply(issues(spark, sf_dir)).select("id", "updated")


@query("q_f23", f"""WITH {ISSUES_SQL} SELECT id, created, updated FROM issues
WHERE (created >= TIMESTAMP '1996-04-01' AND created < TIMESTAMP '1996-05-01')
   OR (updated >= TIMESTAMP '1996-04-01' AND updated < TIMESTAMP '1996-05-01')""")
def f23(spark, sf_dir):
    chunk = in_chunk("1996-04-01", "1996-05-01")
    return issues(spark, sf_dir).where(chunk).select("id", "created", "updated")


@query("q_open_issues", f"""WITH {ISSUES_SQL} SELECT {BRIEF_SQL}, updated,
  ROW_NUMBER() OVER (ORDER BY updated DESC, issue_key) AS position FROM issues
WHERE resolution_date IS NULL AND status_name <> 'P'""")
def open_ones(spark, sf_dir):
    found = issues(spark, sf_dir).where(open_issues("P"))
    return numbered(found.orderBy(F.col("updated").desc(), "issue_key").select(*BRIEF, "updated"))


@query("q_recent_updates", f"""WITH {ISSUES_SQL} SELECT {BRIEF_SQL}, updated,
  ROW_NUMBER() OVER (ORDER BY updated DESC, issue_key) AS position FROM issues
WHERE updated >= TIMESTAMP '2001-08-01' - INTERVAL 60 DAY""")
def recent_updates(spark, sf_dir):
    recent = issues(spark, sf_dir).where(updated_within(60, ORDERS_AS_OF))
    return numbered(recent.orderBy(F.col("updated").desc(), "issue_key").select(*BRIEF, "updated"))


@query("q_f24", f"""WITH {OWNED_SQL} SELECT {BRIEF_SQL}, priority_name,
  ROW_NUMBER() OVER (ORDER BY priority_name DESC NULLS LAST, issue_key) AS position FROM owned_issues
WHERE issue_type_name = 'Epic' AND status_name <> 'F'
  AND (priority_name IN ('1-URGENT', '2-HIGH') OR assignee_display_name = 'Customer#000000037')
  AND project_key IN ('MACHINERY', 'FURNITURE')""")
def f24(spark, sf_dir):
    urgent = F.col("priority_name").isin("1-URGENT", "2-HIGH")
    mine = F.col("assignee_display_name") == "Customer#000000037"
    found = IssueFilter(project_keys=["MACHINERY", "FURNITURE"]).apply(owned_issues(spark, sf_dir))
    found = found.where(of_type_not_in_status("Epic", "F") & (urgent | mine))
    ordered = found.orderBy(F.col("priority_name").desc_nulls_last(), "issue_key")
    return numbered(ordered.select(*BRIEF, "priority_name"))


@query("q_name_any_of", """SELECT p_partkey AS id, p_name AS summary, p_type AS issue_type_name
FROM part WHERE CONTAINS(LOWER(p_name), 'blue') OR CONTAINS(LOWER(p_name), 'gear')""")
def name_any_of(spark, sf_dir):
    found = part_issues(spark, sf_dir).where(contains_any(F.col("summary"), ["Blue", "GEAR"]))
    return found.select("id", "summary", "issue_type_name")


@query("q_f25", "SELECT p_partkey AS id, p_name AS summary FROM part WHERE p_type = 'ECONOMY'")
def f25(spark, sf_dir):
    parts = part_issues(spark, sf_dir).where(F.col("issue_type_name") == "ECONOMY")
    return parts.select("id", "summary")
