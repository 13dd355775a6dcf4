from datetime import datetime, timedelta

import pytest
from generated import HISTORY_COLUMNS, ISSUES, T0, number
from pyspark.sql import functions as F

from trackmill.functions import changes
from trackmill.functions.instants import minute_text, parse_instant, parse_minute, run_seconds
from trackmill.operators import stats, sync
from trackmill.operators.filters import DateRange, IssueFilter


def as_dict(df, key, value="n"):
    return {row[key]: row[value] for row in df.collect()}


def test_storage_stats_equal_recounts(issues):
    rows = {(r.metric, r.key): r.n for r in stats.storage_stats(issues).collect()}
    assert rows[("total", None)] == 500
    for metric, column in (("project", "project_key"), ("status", "status_name"), ("type", "issue_type_name")):
        expected = {(metric, r[0]): r[1] for r in issues.groupBy(column).count().collect()}
        assert {k: v for k, v in rows.items() if k[0] == metric} == expected


def test_stats_leave_out_absent_projects(spark, issues):
    some = issues.withColumn("project_key", F.nullif(F.col("project_key"), F.lit("PRESS1")))
    rows = stats.storage_stats(some).where("metric = 'project'").collect()
    presses = {i.project_key for i in ISSUES} - {"PRESS1"}
    assert len(rows) == len(presses) and sum(r.n for r in rows) == number(lambda i: i.project_key != "PRESS1")
    assert stats.count_by_project(some).count() == len(presses)
    empty = stats.storage_stats(issues.limit(0)).collect()
    assert [(r.metric, r.n) for r in empty] == [("total", 0)]


def test_counts(issues):
    assert stats.total(issues).collect()[0][0] == 500
    assert stats.count_matching(issues, IssueFilter(statuses=["Pulled"], limit=3, offset=9)).collect()[0].n == number(
        lambda i: i.status_name == "Pulled"
    )
    nobody = number(lambda i: i.assignee_display_name is None)
    assert [r.n for r in stats.top_values(issues, "assignee_display_name", 1, stats.UNASSIGNED).collect()] == [nobody]
    assert stats.top_values(issues, "assignee_display_name", 50).count() == 9
    assert sum(r.n for r in stats.distribution(issues, ["project_key"], "priority_name").collect()) == 500
    shares = stats.share_of_total(issues, "project_key").collect()
    presses = {i.project_key for i in ISSUES}
    assert {r.project_key: r.percent for r in shares} == {
        press: pytest.approx(number(lambda i: i.project_key == press) / 5) for press in presses
    }
    assert stats.distinct_values(issues, "project_key").count() == len(presses)


def test_creation_rate(issues):
    row = stats.creation_rate(issues, T0).collect()[0]
    recent = [number(lambda i: i.created >= T0 - timedelta(days=days)) for days in (7, 30)]
    assert [row.created_7d, row.created_30d] == recent
    assert row.rate_7d == round(recent[0] / 7, 6)


def test_completeness(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", ""), (None, "y"), (None, None)], "lead string, text string")
    row = stats.completeness(rows, ["lead", "text"]).collect()[0]
    assert (row["rows"], row.complete, row.missing_lead, row.missing_text, row.complete_percent) == (4, 1, 2, 2, 25.0)
    assert stats.completeness(rows.limit(0), ["lead"]).collect()[0].complete_percent == 0.0


def test_history_stats(history):
    row = stats.history_stats(history).collect()[0]
    assert (row.total_changes, row.unique_issues, row.unique_authors) == (30, 10, 5)
    assert (row.oldest_change, row.newest_change) == (T0 - timedelta(hours=29), T0)
    assert stats.history_stats(history, approximate=True).collect()[0].unique_issues == 10
    assert as_dict(stats.changes_per_field(history), "field_name") == {"status": 8, "assignee": 8, "priority": 7, "summary": 7}
    assert [r.changes for r in stats.top_authors(history, 2).collect()] == [6, 6]
    picked = stats.top_authors(history, 5, DateRange.last_hours(9, T0), {"field_name": ["status"]})
    assert sum(r.changes for r in picked.collect()) == 3


def test_change_types_and_sentence(spark):
    base = (0, "1", "A-1", "c", datetime(2024, 1, 15, 10, 30))
    fields = [("status", None), ("assignee", None), ("priority", None), ("Sprint", "cf_1"), ("summary", None)]
    rows = [(*base, "u" if i else None, "Ann" if i else None, None, name, fid, None, None, None, "new")
            for i, (name, fid) in enumerate(fields)]
    df = spark.createDataFrame(rows, HISTORY_COLUMNS)
    kinds = [r[0] for r in df.select(changes.change_type()).collect()]
    assert kinds == ["StatusChange", "AssigneeChange", "PriorityChange", "CustomField", "FieldUpdate"]
    assert as_dict(stats.change_type_counts(df), "change_group") == {label: 1 for label in changes.CHANGE_LABELS.values()}
    first, second = [r[0] for r in df.select(changes.change_sentence()).limit(2).collect()]
    assert first == "2024-01-15 10:30:00: System changed status from 'None' to 'new'"
    assert second == "2024-01-15 10:30:00: Ann changed assignee from 'None' to 'new'"
    authors = [r[0] for r in df.select(changes.author_struct()).collect()]
    assert authors[0] is None and authors[1].display_name == "Ann"
    assert stats.change_type_map(df, "issue_key").collect()[0].changes["CustomField"] == 1


def test_instants(spark):
    texts = ["2024-01-15T10:30:00.000+0000", "2024-01-15T10:30:00Z", "2024-01-15T19:30:00+0900",
             "2024-01-15T19:30:00.5+09:00", "2024-01-15T10:30:00", "2024-01-15", "junk", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = [r[0] for r in rows.select(parse_instant(F.col("t"))).collect()]
    stamp = datetime(2024, 1, 15, 10, 30)
    assert parsed == [stamp, stamp, stamp, stamp.replace(microsecond=500000), None, None, None, None]
    minute = spark.createDataFrame([("2024-01-15 14:30",), ("x",)], "t string")
    back = minute.select(minute_text(parse_minute(F.col("t")))).collect()
    assert [r[0] for r in back] == ["2024-01-15 14:30", None]


def test_field_profile(spark):
    docs = spark.createDataFrame([('{"a":1,"b":"x","c":null,"d":[1],"e":{"k":1},"f":true}',), ('{"a":"y"}',), ("junk",)], "j string")
    found = {(r.field, r.json_type): r.n for r in stats.field_profile(docs, "j").collect()}
    assert found == {("a", "Number"): 1, ("a", "String"): 1, ("b", "String"): 1, ("c", "null"): 1,
                     ("d", "Array"): 1, ("e", "Object"): 1, ("f", "Boolean"): 1}


# --- synchronisation ---------------------------------------------------------

RUNS = "service string, run_id long, start_time timestamp, end_time timestamp, synced_count long, is_success boolean"


def test_sync_stats(spark):
    rows = spark.createDataFrame([
        ("s", 1, T0, T0 + timedelta(seconds=2), 100, True),
        ("s", 2, T0 + timedelta(hours=1), T0 + timedelta(hours=1, seconds=4), 50, False),
    ], RUNS)
    row = stats.sync_stats(rows).collect()[0]
    assert (row.total_syncs, row.successful_syncs, row.total_issues_synced) == (2, 1, 150)
    assert row.average_duration_seconds == 3.0
    assert row.last_sync_time == T0 + timedelta(hours=1, seconds=4)
    assert row.last_successful_sync_time == T0 + timedelta(seconds=2)
    none = stats.sync_stats(rows.limit(0)).collect()[0]
    assert (none.total_syncs, none.average_duration_seconds, none.last_sync_time) == (0, 0.0, None)
    assert rows.select(run_seconds(F.col("start_time"), F.col("end_time"))).collect()[0][0] == 2.0


def test_due(spark):
    rows = spark.createDataFrame([
        ("fresh", 1, T0, T0 - timedelta(minutes=59, seconds=59), 1, True),
        ("old", 1, T0, T0 - timedelta(minutes=60), 1, True),
        ("failing", 1, T0, T0, 1, False),
    ], RUNS)
    assert sorted(r.service for r in sync.due(rows, rows, 60, T0).collect()) == ["failing", "old"]


def test_incremental(issues):
    shown = ("id", "issue_key", "project_key", "status_name", "created", "updated")
    source = issues.select(*shown)
    since = T0 - timedelta(hours=2)
    known = source.where("status_name != 'Pulled'").withColumn(
        "updated", F.when(F.col("updated") > F.lit(since), F.lit(since)).otherwise(F.col("updated")))
    outcome = sync.incremental(source, known, since, T0)
    kinds = {r.sync_kind: r["count"] for r in outcome.fetched.groupBy("sync_kind").count().collect()}
    recent = source.where((F.col("updated") >= F.lit(since)) | (F.col("created") >= F.lit(since)))
    moved = recent.where((F.col("status_name") != "Pulled") & (F.col("updated") > F.lit(since)))
    assert kinds == {"new": recent.where("status_name = 'Pulled'").count(), "updated": moved.count()}
    totals = outcome.projects.agg(F.sum("synced_count"), F.sum("new_count"), F.sum("updated_count")).collect()[0]
    assert tuple(totals) == (sum(kinds.values()), kinds["new"], kinds["updated"])
    assert outcome.merged.count() == number(lambda i: i.status_name != "Pulled") + kinds["new"]
    again = sync.incremental(source, outcome.merged, since, T0)
    assert again.fetched.count() == 0
    assert outcome.merged.exceptAll(again.merged).count() == 0


def test_full_reload_and_deletions(issues):
    source = issues.where("status_name != 'Bound'")
    outcome = sync.full(source, issues, T0)
    bound = number(lambda i: i.status_name == "Bound")
    assert outcome.merged.count() == 500 - bound
    gone = sync.deleted_keys(issues, source)
    assert gone.count() == bound
    record = sync.run_record(outcome.projects, "s", 1, T0, T0 + timedelta(seconds=1), gone).collect()[0]
    assert (record.synced_count, record.updated_count, record.deleted_count, record.is_success) == (
        500 - bound, 500 - bound, bound, True
    )


def test_failed_project(issues):
    fetched = issues.withColumn("sync_kind", F.lit("new"))
    failed = issues.where("project_key = 'PRESS1'").select("project_key")
    rows = {r.project_key: r for r in sync.project_rollup(fetched, T0, failed).collect()}
    assert (rows["PRESS1"].error_count, rows["PRESS1"].synced_count) == (1, 0)
    assert (rows["PRESS2"].error_count, rows["PRESS2"].synced_count) == (
        0, number(lambda i: i.project_key == "PRESS2")
    )
