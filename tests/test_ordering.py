import pytest
from generated import T0
from pyspark.sql import functions as F

from trackmill.operators.filters import HistoryFilter, IssueFilter
from trackmill.operators.ordering import (
    ISSUE_SORTS, assign_pages, issue_order, latest, load_history, load_issues, page_after, take_page,
    with_position,
)


@pytest.mark.parametrize("sort_order", sorted(ISSUE_SORTS))
def test_sort_orders(issues, sort_order):
    column, ascending = ISSUE_SORTS[sort_order]
    rows = load_issues(issues, IssueFilter(sort_order=sort_order)).select(column, "issue_key").collect()
    values = [row[0] for row in rows]
    assert values == sorted(values, reverse=not ascending)
    if column != "issue_key":
        assert all(a[1] < b[1] for a, b in zip(rows, rows[1:]) if a[0] == b[0])


def test_null_priority_is_last_both_ways(spark):
    rows = spark.createDataFrame([("1", "A-1", None), ("2", "A-2", "Haste"), ("3", "A-3", "Lull")], "id string, issue_key string, priority_name string")
    for direction in ("priority_asc", "priority_desc"):
        assert rows.orderBy(*issue_order(direction)).collect()[-1].id == "1"
    ranked = rows.orderBy(*issue_order("priority_asc", {"Lull": 1, "Haste": 2})).collect()
    assert [row.id for row in ranked] == ["3", "2", "1"]


def test_pages_concatenate_to_the_full_sort(issues):
    order = issue_order("created_asc")
    whole = [row.id for row in issues.orderBy(*order).collect()]
    pages = []
    for start in range(0, 520, 130):
        pages += [row.id for row in take_page(issues, order, 130, start).collect()]
    assert pages == whole
    assert take_page(issues, order, 10, 500).count() == 0


def test_deep_pages_come_from_positions(issues):
    order = issue_order("updated_desc")
    whole = [row.id for row in issues.orderBy(*order).collect()]
    assert [r.id for r in take_page(issues, order, 50, 200, positions=True).collect()] == whole[200:250]
    assert [r.id for r in take_page(issues, order, None, 480).collect()] == whole[480:]
    assert [r.id for r in take_page(issues, order, 20, 0, positions=True).collect()] == whole[:20]


def test_positions_are_dense(issues):
    numbered = with_position(issues.repartition(7), issue_order("created_desc"))
    rows = numbered.orderBy("position").select("position", "id").collect()
    assert [row.position for row in rows] == list(range(1, 501))
    assert [row.id for row in rows] == [r.id for r in issues.orderBy(*issue_order("created_desc")).collect()]


def test_positions_with_one_hot_value(spark):
    rows = spark.range(1000).select(F.lit(7).alias("hot"), "id")
    numbered = with_position(rows, [F.col("hot"), F.col("id")])
    assert numbered.where(F.col("position") != F.col("id") + 1).count() == 0


def test_assigned_pages(issues):
    paged = assign_pages(issues, issue_order("key_asc"), 120)
    assert {r.page: r["count"] for r in paged.groupBy("page").count().collect()} == {0: 120, 1: 120, 2: 120, 3: 120, 4: 20}
    with pytest.raises(ValueError):
        assign_pages(issues, issue_order("key_asc"), 0)


def test_keyset_page_continues(issues):
    order = issue_order("created_asc")
    first = take_page(issues, order, 100).collect()
    following = page_after(issues, first[-1].created, first[-1].issue_key, 100).collect()
    assert [r.id for r in following] == [r.id for r in take_page(issues, order, 100, 100).collect()]


def test_history_load(history):
    assert [r.history_id for r in load_history(history, HistoryFilter(limit=3)).collect()] == [0, 1, 2]
    oldest = load_history(history, HistoryFilter(sort_order="timestamp_asc", limit=1)).collect()
    assert oldest[0].history_id == 29
    by_field = [r.field_name for r in load_history(history, HistoryFilter(sort_order="field_name")).collect()]
    assert by_field == sorted(by_field)
    assert latest(history, "change_timestamp").collect()[0].change_timestamp == T0
