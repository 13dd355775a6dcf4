"""What the physical plans must and must not hold."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from trackmill.operators.grouping import first_seen, latest_per_project
from trackmill.operators.joins import classify
from trackmill.operators.ordering import issue_order, take_page
from trackmill.operators.stats import storage_stats
from trackmill.plans.registry import REGISTRY
from trackmill.plans.standins import owned_issues, table

SF_DIR = driver.SMOKE_DIR
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")

# Queries that write or stream do so when they are built.
EAGER = {"q_scan_pages", "q_s2", "q_s3", "q_s6", "q_s8", "q_s9", "q_s12", "q_s14", "q_s15",
         "q_t3", "q_t6", "q_t7", "q_o11", "q_o12", "q_incremental", "q_a17", "q_sync_rounds",
         "q_project_history_stats", "q_s2_split", "q_t3_projects", "q_t3_projects_merged", "q_t3_marks", "q_u2_digest",
         "q_s14_delta", "q_s6_feed", "q_s6_bucketed", "q_a7_sketch", "q_s15_curve", "q_f10_indexed", "q_o11_stored", "q_f7_stored", "q_f17_stored", "q_s12_quarantine", "q_s2_array"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run(spark, name):
    return driver.queries()[name](spark, SF_DIR)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - EAGER))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(run(spark, name))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert banned not in text, banned


@pytest.mark.parametrize("name, pushed", [
    ("q_f2", "In(o_orderstatus"), ("q_f7", "GreaterThanOrEqual(o_orderdate"), ("q_f17", "LessThanOrEqual(l_shipdate"),
    ("q_j3", "EqualTo(o_orderstatus,F)"),
    ("q_creation_rate", "GreaterThanOrEqual(o_orderdate"), ("q_f25", "EqualTo(p_type,ECONOMY)"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(run(spark, name))


def test_only_needed_columns_are_read(spark):
    text = plan(run(spark, "q_by_status"))
    assert "ReadSchema: struct<o_orderstatus:string>" in text


def test_top_k_is_not_a_full_sort(spark):
    for name in ("q_topk", "q_page", "q_assignee_top", "q_latest", "q_f19"):
        assert "TakeOrderedAndProject" in plan(run(spark, name)), name


def test_per_group_limits_run_before_the_shuffle(spark):
    events = table(spark, SF_DIR, "events")
    for df in (
        latest_per_project(owned_issues(spark, SF_DIR)),
        first_seen(events, ["user_id"], [F.col("ts")]),
    ):
        text = plan(df)
        final, partial = text.index("row_number(), "), text.rindex("Partial")
        assert "WindowGroupLimit" in text and final < partial
        assert text.index("Exchange hashpartitioning") < partial


def test_statistics_read_the_issues_once(spark):
    text = plan(storage_stats(owned_issues(spark, SF_DIR)))
    assert text.count("orders.parquet") == 1
    assert text.index("Expand") < text.index("partial_count")


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("q_by_project", "q_field_counts", "q_chunk_counts", "q_u2"):
        assert "partial_" in plan(run(spark, name)), name


@pytest.mark.parametrize("name, tables", [
    ("q_exclude_existing", ["customer", "orders"]), ("q_j3", ["lineitem", "orders"]),
])
def test_key_joins_read_each_input_once(spark, name, tables):
    text = plan(run(spark, name))
    assert [text.count(f"{table_}.parquet") for table_ in tables] == [1] * len(tables)
    assert "approx_top_k" not in text


def test_texts_are_not_moved_to_find_their_copies(spark):
    text = plan(run(spark, "q_w1"))
    below = text[text.index("Exchange"):]
    assert "sha2" in below and "text#" not in text[:text.rindex("Exchange")]


def test_history_statistics_multiply_no_row(spark):
    assert "Expand" not in plan(run(spark, "q_history_stats"))


@pytest.mark.parametrize("name, bound", [("q_f7_stored", "created_date"), ("q_f17_stored", "change_month")])
def test_stored_tables_are_pruned(spark, name, bound):
    assert f"PartitionFilters: [isnotnull({bound}" in plan(run(spark, name))


def test_deep_limits_start_no_job(spark):
    rows = owned_issues(spark, SF_DIR)  # reading a schema is a job
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    take_page(rows, issue_order("created_desc"), limit=100_001)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_history_statistics_read_history_once(spark):
    assert plan(run(spark, "q_history_stats")).count("lineitem.parquet") == 1


def test_the_known_table_is_cut_to_the_fetched_keys_before_it_is_grouped(spark):
    known = table(spark, SF_DIR, "orders").selectExpr("o_orderkey AS issue_key", "o_orderdate AS updated")
    text = plan(classify(known.limit(10), known, version="updated", few=True))
    assert "LeftSemi" in text and text.index("collect_set") < text.index("LeftSemi")
