from datetime import timedelta

import pytest
from generated import ISSUES, T0, number
from pyspark.sql import functions as F

from trackmill.operators.chunks import rows_per_chunk, time_chunks, window_chunks
from trackmill.operators.filters import TimeWindow
from trackmill.operators.grouping import first_by_text, first_seen, latest_per_project, retain_last, timeline, top_per_group
from trackmill.operators.joins import (
    assign_chunks, chunk_index, classify, exclude_known, exclude_unchanged, hot_keys, join_history,
    keep_known, spread_join,
)
from trackmill.operators.setops import concat, overlap, reconcile, reconcile_summary
from trackmill.operators.upsert import delete_keys, deleted_rows, duplicate_keys, upsert


@pytest.mark.parametrize("n", [100, 300, 500])
def test_dedup_restores_the_batch(issues, n):
    batch = issues.orderBy("id").limit(n).withColumn("seq", F.lit(0))
    repeated = concat([batch, batch.orderBy("id").limit(n // 4).withColumn("seq", F.lit(1))])
    kept = first_seen(repeated, ["issue_key"], [F.col("seq")])
    assert kept.count() == n and kept.where("seq = 1").count() == 0


def test_first_by_text(spark):
    rows = spark.createDataFrame([(2, "a"), (1, "a"), (3, "b"), (4, None), (5, None)], "id int, text string")
    kept = first_by_text(rows, "text", [F.col("id")])
    assert sorted(r.id for r in kept.collect()) == [1, 3, 4]


def test_top_beyond_the_rank_limit(spark):
    rows = spark.range(5000).repartition(6).select((F.col("id") % 3).alias("g"), "id")
    top = top_per_group(rows, ["g"], [F.col("id").desc()], 1500)
    best = sorted(r.id for r in top.where("g = 0").select("id").collect())
    assert len(best) == 1500 and best == sorted(i for i in range(5000) if i % 3 == 0)[-1500:]
    assert top.count() == 4500


def test_retention(spark):
    rows = spark.createDataFrame([("s", 1, 10, True), ("s", 2, 20, False), ("s", 3, 30, True)], "service string, run_id int, n int, ok boolean")
    kept = retain_last(rows, "service", [F.col("run_id").desc()], 2)
    assert sorted(r.n for r in kept.collect()) == [20, 30]
    with pytest.raises(ValueError):
        retain_last(rows, "service", [F.col("run_id").desc()], 0)


def test_latest_per_project(issues):
    rows = latest_per_project(issues).collect()
    expected = set()
    for press in {i.project_key for i in ISSUES}:
        own = sorted((i for i in ISSUES if i.project_key == press), key=lambda i: (T0 - i.created, i.issue_key, i.id))
        expected |= {i.issue_key for i in own[:3]}
    assert {r.issue_key for r in rows} == expected


def test_timeline(history):
    rows = timeline(history, ["change_id"]).collect()
    assert [(r.issue_key, r.change_timestamp) for r in rows] == sorted((r.issue_key, r.change_timestamp) for r in rows)


# --- joins -------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows carry one key; some keys are unknown, some are null."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 700).cast("string")))
    return spark.range(6000).repartition(8).select("id", key.alias("issue_key")).cache()


@pytest.fixture(scope="module")
def some_keys(spark):
    names = [("hot",)] * 5 + [(f"k{i}",) for i in range(0, 700, 2)]
    return spark.createDataFrame(names, "issue_key string").cache()


def test_hot_keys_are_found(skewed):
    assert hot_keys(skewed, "issue_key", 0.1).collect()[0].hot == ["hot"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(skewed, some_keys, how):
    right = some_keys.distinct().withColumn("flag", F.lit(1))
    plain = skewed.join(right, ["issue_key"], how)
    spread = spread_join(skewed, right, ["issue_key"], how)
    assert plain.count() == spread.count()
    assert plain.exceptAll(spread.select(*plain.columns)).count() == 0


def test_hot_key_spreads_over_tasks(spark, skewed, some_keys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(skewed, some_keys.distinct(), ["issue_key"], "inner")
        parts = joined.where("issue_key = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1


def test_known_keys(skewed, some_keys):
    known, unknown = keep_known(skewed, some_keys), exclude_known(skewed, some_keys)
    assert known.count() + unknown.count() == 6000
    assert unknown.where("issue_key is null").count() == skewed.where("issue_key is null").count()
    kinds = {r.sync_kind: r["count"] for r in classify(skewed, some_keys).groupBy("sync_kind").count().collect()}
    assert kinds == {"updated": known.count(), "new": unknown.count()}


def test_unchanged_issues_are_excluded(issues):
    known = issues.where("status_name != 'Pulled'")
    moved = issues.withColumn("updated", F.when(F.col("status_name") == "Drying", F.lit(T0)).otherwise(F.col("updated")))
    left = exclude_unchanged(moved, known)
    assert left.where("status_name = 'Pulled'").count() == number(lambda i: i.status_name == "Pulled")
    assert left.where("status_name = 'Bound'").count() == 0


def test_issue_history_join(spark, history):
    rows = spark.createDataFrame([("1", "TYPE-1", "One", "P"), ("2", "TYPE-2", "Two", "Q")], "id string, issue_key string, summary string, project_key string")
    joined = join_history(rows, history, "P").collect()
    assert [r.change_id for r in joined] == ["c0", "c10", "c20"]
    assert join_history(rows, history, "P", "status").count() == 2


# --- chunks ------------------------------------------------------------------


@pytest.mark.parametrize("start, end, hours, count, last_seconds", [
    ("2024-01-01T00:00", "2024-01-01T06:00", 2, 3, 7200),
    ("2024-01-01T00:00", "2024-01-01T07:00", 2, 4, 3600),
    ("2024-01-01T00:00", "2024-01-03T00:00", 6, 8, 21600),
])
def test_chunk_counts(spark, start, end, hours, count, last_seconds):
    rows = time_chunks(spark, start, end, hours).orderBy("chunk").collect()
    assert len(rows) == count and rows[-1].duration_seconds == last_seconds
    assert all(a.chunk_end == b.chunk_start for a, b in zip(rows, rows[1:]))


def test_degenerate_chunks(spark):
    assert time_chunks(spark, "2024-01-02", "2024-01-01", 1).count() == 0
    assert time_chunks(spark, "2024-01-01", "2024-01-01", 1).count() == 0
    assert window_chunks(spark, TimeWindow(until="2024-02-01", granularity_hours=24), T0).count() == 30
    assert window_chunks(spark, TimeWindow(granularity_hours=24), T0).count() == 30


def test_rows_per_chunk_sum_to_the_rows(issues):
    counted = rows_per_chunk(issues, "created", T0 - timedelta(days=364), T0, 100)
    assert counted.agg(F.sum("n")).collect()[0][0] == 500


def test_chunk_index_agrees_with_range_join(spark, history):
    start, end = T0 - timedelta(hours=29), T0 + timedelta(hours=1)
    chunks = time_chunks(spark, start, end, 4).select("chunk", "chunk_start", "chunk_end")
    joined = assign_chunks(history, chunks, "change_timestamp", ["history_id"], 6)
    direct = history.select("history_id", chunk_index(F.col("change_timestamp"), start, end, 4).alias("chunk"))
    assert direct.exceptAll(joined.select("history_id", "chunk")).count() == 0
    assert joined.count() == 30


# --- sets, upsert, delete ----------------------------------------------------


def test_reconcile(issues):
    left, right = issues.where("status_name != 'Drying'"), issues.where("status_name != 'Pulled'")
    row = reconcile_summary(left, right).collect()[0]
    drying, pulled = number(lambda i: i.status_name == "Drying"), number(lambda i: i.status_name == "Pulled")
    shared = 500 - drying - pulled
    assert row.asDict() == {
        "left_count": 500 - drying, "right_count": 500 - pulled, "shared_keys": shared, "only_left": pulled,
        "only_right": drying,
    }
    assert reconcile(issues, issues).count() == 0
    assert reconcile(left, right).count() == drying + pulled
    assert overlap(left, right).count() == shared


def test_upsert(spark):
    target = spark.createDataFrame([("1", "old", 1), ("2", "old", 1)], "id string, status string, seq int")
    incoming = spark.createDataFrame([("2", "first", 2), ("2", "last", 3), ("3", "new", 2)], "id string, status string, seq int")
    order = [F.col("seq").desc()]
    merged = upsert(target, incoming, "id", order)
    assert {r.id: r.status for r in merged.collect()} == {"1": "old", "2": "last", "3": "new"}
    again = upsert(merged, incoming, "id", order)
    assert merged.exceptAll(again).count() == 0 and again.count() == 3


def test_delete(spark, issues):
    listed = [ISSUES[0].issue_key, ISSUES[1].issue_key, "none", ISSUES[0].issue_key]
    keys = spark.createDataFrame([(key,) for key in listed], "issue_key string")
    assert deleted_rows(issues, keys).count() == 2
    assert delete_keys(issues, keys).count() == 498
    empty = keys.limit(0)
    assert deleted_rows(issues, empty).count() == 0 and delete_keys(issues, empty).count() == 500


def test_duplicate_keys(spark):
    rows = spark.createDataFrame([("1", "A"), ("2", "A"), ("3", "B"), ("3", "B")], "id string, issue_key string")
    assert [(r.issue_key, r.ids) for r in duplicate_keys(rows).collect()] == [("A", 2)]
