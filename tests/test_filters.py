from datetime import datetime, timedelta, timezone

import pytest
from generated import ISSUES, T0, number
from pyspark.sql import functions as F

from trackmill.functions.text import contains_any
from trackmill.operators import filters
from trackmill.operators.filters import INLINE_KEYS, DateRange, HistoryFilter, IssueFilter, TimeWindow, in_chunk
from trackmill.sources.tables import overwrite_history


def keys(df):
    return sorted(row[0] for row in df.select("issue_key").collect())


def test_empty_filter_keeps_everything(issues):
    assert IssueFilter().is_empty()
    assert IssueFilter(limit=3, offset=1).is_empty()
    assert not IssueFilter(labels=["x"]).is_empty()
    assert IssueFilter().apply(issues).count() == 500


@pytest.mark.parametrize("spec, expected", [
    (IssueFilter(project_keys=["PRESS1"]), lambda i: i.project_key == "PRESS1"),
    (IssueFilter(project_keys=["PRESS1", "PRESS2"], statuses=["Pulled"]),
     lambda i: i.project_key in ("PRESS1", "PRESS2") and i.status_name == "Pulled"),
    (IssueFilter(statuses=["pulled"]), lambda i: False),
    (IssueFilter(priorities=["Haste", "Lull"]), lambda i: i.priority_name in ("Haste", "Lull")),
    (IssueFilter(issue_types=["Blot"]), lambda i: i.issue_type_name == "Blot"),
    (IssueFilter(reporters=["Hand 1"]), lambda i: i.reporter_display_name == "Hand 1"),
    (IssueFilter(assignees=["Hand 1"]), lambda i: i.assignee_display_name == "Hand 1"),
    (IssueFilter(created_range=DateRange(T0 - timedelta(days=30), T0)), lambda i: i.created >= T0 - timedelta(days=30)),
    (IssueFilter(created_range=DateRange(T0, T0 - timedelta(days=30))), lambda i: False),
    (IssueFilter(updated_range=DateRange(T0 - timedelta(hours=1), T0)), lambda i: i.updated >= T0 - timedelta(hours=1)),
    (IssueFilter(summary_contains="NUMBER 49"), lambda i: "number 49" in i.summary),
    (IssueFilter(description_contains="100% OF_7"), lambda i: "of_7" in i.description),
    (IssueFilter(description_contains="%"), lambda i: True),
    (IssueFilter(description_contains="_of"), lambda i: False),
])
def test_conditions(issues, spec, expected):
    assert spec.apply(issues).count() == number(expected)


def test_range_counts_both_ends(issues):
    rows = IssueFilter(created_range=DateRange.last_days(30, T0)).apply(issues)
    ages = {row[0] for row in rows.select(F.datediff(F.lit(T0), "created")).collect()}
    assert ages == {(T0 - i.created).days for i in ISSUES if (T0 - i.created).days <= 30}
    assert {0, 30} <= ages


def test_null_never_matches(spark):
    rows = spark.createDataFrame([(None, None, "a"), ("P", "x", None)], "project_key string, description string, assignee_display_name string")
    assert IssueFilter(project_keys=["P"]).apply(rows).count() == 1
    assert IssueFilter(description_contains="x").apply(rows).count() == 1
    assert IssueFilter(assignees=["a"]).apply(rows).count() == 1


def test_labels(spark):
    rows = spark.createDataFrame([("1", ["a", "b"]), ("2", ["c"]), ("3", None)], "id string, labels array<string>")
    assert [r.id for r in IssueFilter(labels=["b", "z"]).apply(rows).collect()] == ["1"]


def test_long_lists_join_as_a_table(issues, monkeypatch):
    inline = IssueFilter(project_keys=["PRESS1", "PRESS2", "PRESS3"], statuses=["Pulled"])
    expected = keys(inline.apply(issues))
    monkeypatch.setattr(filters, "INLINE_KEYS", 2)
    assert keys(inline.apply(issues)) == expected


def test_range_validation_and_zones():
    with pytest.raises(ValueError):
        DateRange("2024-01-02", "2024-01-01").validate()
    tokyo = timezone(timedelta(hours=9))
    assert filters.as_utc(datetime(2024, 1, 1, 9, tzinfo=tokyo)) == datetime(2024, 1, 1)
    assert filters.as_utc("2024-01-01T00:00:00+00:00") == datetime(2024, 1, 1)


def test_history_filter(history):
    assert HistoryFilter(issue_keys=["TYPE-1"]).apply(history).count() == 3
    assert HistoryFilter(issue_keys=[]).apply(history).count() == 30
    assert HistoryFilter(field_names=["status"]).apply(history).count() == 8
    assert HistoryFilter(authors=["user-0", "user-1"]).apply(history).count() == 12
    assert HistoryFilter(change_types=["FieldUpdate"]).apply(history).count() == 7
    assert HistoryFilter(date_range=DateRange.last_hours(5, T0)).apply(history).count() == 6


@pytest.mark.parametrize("bad", [
    {"limit": 0}, {"date_range": DateRange("2024-01-02", "2024-01-01")}, {"change_types": ["Nope"]},
])
def test_history_filter_is_validated(bad):
    with pytest.raises(ValueError):
        HistoryFilter(**bad)


@pytest.mark.parametrize("bad", [
    {"since": "2024-01-02", "until": "2024-01-01"}, {"granularity_hours": 0},
    {"by_created": False, "by_updated": False},
])
def test_time_window_is_validated(bad):
    with pytest.raises(ValueError):
        TimeWindow(**bad)


def test_time_window(issues):
    assert TimeWindow().apply(issues).count() == 500
    day = TimeWindow(T0 - timedelta(days=1), T0)
    assert day.apply(issues).count() == 500
    yesterday = T0 - timedelta(days=1)
    assert TimeWindow(yesterday, T0, by_updated=False).apply(issues).count() == number(lambda i: i.created >= yesterday)
    assert TimeWindow(since=T0, by_created=False).apply(issues).count() == number(lambda i: i.updated >= T0)
    excluded = day.excluding([ISSUES[0].issue_key, ISSUES[1].issue_key])
    assert excluded.apply(issues).count() == 498


def test_whole_minutes(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 10, 0, 30),)], "created timestamp")
    late = TimeWindow("2024-01-01T10:00:45", None, by_updated=False)
    assert rows.where(late.condition()).count() == 0
    assert rows.where(TimeWindow("2024-01-01T10:00:45", None, by_updated=False, whole_minutes=True).condition()).count() == 1


def test_chunk_borders_count_once(spark):
    stamps = [datetime(2024, 1, 1, h) for h in (0, 2, 4)]
    rows = spark.createDataFrame([(s, s) for s in stamps], "created timestamp, updated timestamp")
    first = rows.where(in_chunk(stamps[0], stamps[1])).count()
    last = rows.where(in_chunk(stamps[1], stamps[2], last=True)).count()
    assert (first, last) == (1, 2)
    assert rows.where(in_chunk(stamps[0], stamps[1], created=False, updated=False)).count() == 1


def test_idioms(issues):
    unresolved = number(lambda i: i.resolution_date is None)
    assert issues.where(filters.unresolved()).count() == unresolved
    assert issues.where(filters.open_issues("Pulled")).count() == unresolved - number(lambda i: i.status_name == "Pulled")
    assert issues.where(filters.of_type_not_in_status("Blot", "Drying")).count() == number(
        lambda i: i.issue_type_name == "Blot" and i.status_name != "Drying"
    )
    assert issues.where(filters.updated_within(7, T0)).count() == 500
    assert issues.where(contains_any(F.col("summary"), ["NUMBER 1", "zzz"])).count() == number(
        lambda i: "number 1" in i.summary
    )
    assert issues.where(contains_any(F.col("summary"), [])).count() == 0


@pytest.mark.parametrize("name, column", IssueFilter.LISTS)
def test_long_lists_change_nothing(issues, name, column):
    few = [r[0] for r in issues.select(column).where(F.col(column).isNotNull()).distinct().limit(2).collect()]
    long = few + [f"none-{i}" for i in range(INLINE_KEYS + 1 - len(few))]
    short, joined = (IssueFilter(**{name: values}).apply(issues) for values in (few, long))
    assert joined.columns == short.columns == issues.columns
    assert sorted(short.collect()) == sorted(joined.collect())


def test_long_exclusions_change_nothing(issues):
    few = [r[0] for r in issues.select("issue_key").limit(3).collect()]
    long = few + [f"none-{i}" for i in range(INLINE_KEYS + 1 - len(few))]
    short, joined = (TimeWindow().excluding(values).apply(issues) for values in (few, long))
    assert joined.columns == issues.columns
    assert sorted(r.id for r in short.collect()) == sorted(r.id for r in joined.collect())


def test_history_is_pruned_by_month(spark, history, tmp_path):
    path = str(tmp_path / "history")
    overwrite_history(history, path)
    stored = spark.read.parquet(path)
    spec = HistoryFilter(date_range=DateRange("2024-05-31", "2024-06-01"))
    found = spec.apply(stored)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(change_month" in text
    assert found.count() == spec.apply(history).count()
