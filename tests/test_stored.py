"""What a store keeps up beside its rows."""

import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trackmill.operators import digests, project_sync, stats, upsert
from trackmill.operators.filters import DateRange
from trackmill.operators.setops import reconcile
from trackmill.sources import buckets, curve, sketches, sorted_files, text_index
from trackmill.streaming import marks
from trackmill.streaming.incremental import drops, run_to_end

T = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


# --- digests -----------------------------------------------------------------


@pytest.fixture
def stores(spark, tmp_path):
    left = spark.range(2000).selectExpr("IF(id % 3 = 0, 5, id) AS k", "id AS version").union(spark.sql("SELECT CAST(NULL AS BIGINT), 1L"))
    right = left.where("k IS NULL OR k NOT IN (8, 10)").union(left.where("k = 11"))
    for name, df in (("left", left), ("right", right)):
        digests.save_by_range(df, str(tmp_path / name), "k")
    return [spark.read.parquet(str(tmp_path / name)) for name in ("left", "right")]


def test_digests_find_what_a_full_comparison_finds(spark, stores):
    found = digests.reconcile_by_digest(*stores, "k")
    assert sorted(found.collect()) == sorted(reconcile(*stores, "k").collect()) == [(8, 1, 0), (10, 1, 0), (11, 1, 2)]


def test_equal_ranges_are_not_read(spark, stores):
    found = digests.reconcile_by_digest(*stores, "k")
    ranges = {row[0] for row in stores[0].where("k IN (8, 10, 11)").select(digests.RANGE).collect()}
    text = plan(found)
    listed = ",".join(map(str, sorted(ranges)))
    assert 1 <= len(ranges) <= 3 and text.count("PartitionFilters: [key_range") == 2 and text.count("key_range#") >= 2
    assert all(str(number) in text for number in listed.split(","))
    # The rows that are compared, out of 2001 on each side.
    assert all(side.where(F.col(digests.RANGE).isin(list(ranges))).count() < 100 for side in stores)
    assert digests.reconcile_by_digest(stores[0], stores[0], "k").count() == 0


def test_kept_digests_and_other_columns(spark, stores):
    left, right = stores
    moved = left.withColumn("version", F.when(F.col("k") == 20, 0).otherwise(F.col("version")))
    kept = [digests.range_digests(side, "k", ["version"]) for side in (left, moved)]
    assert [row["node"] for row in digests.differing_ranges(*kept).collect()] == [
        row[0] for row in left.where("k = 20").select(digests.RANGE).collect()
    ]
    # Rows in another order, dealt otherwise, have the same digests.
    again = digests.range_digests(left.orderBy(F.col("version").desc()).repartition(3), "k", ["version"])
    assert digests.differing_ranges(kept[0], again).count() == 0
    assert digests.differing_ranges(kept[0], kept[0].limit(0)).count() == kept[0].count()


# --- statistics by changes -----------------------------------------------------

ISSUE = "id string, project_key string, status_name string, issue_type_name string, updated int"


def test_folded_statistics_equal_a_recount(spark, tmp_path):
    base = spark.createDataFrame([(str(i), f"P{i % 3}" if i % 5 else None, "Open", "Bug", 1) for i in range(100)], ISSUE)
    stats.storage_stats(base).write.parquet(str(tmp_path / "stats"))
    incoming = spark.createDataFrame(
        [("3", "P9", "Done", "Bug", 2), ("3", "P0", "Done", "Bug", 3), ("100", None, "New", "Epic", 1), ("7", "P1", "Open", "Bug", 2)], ISSUE
    )
    gone = spark.createDataFrame([("1",), ("1",), ("3",), ("999",)], "id string")
    feed = upsert.change_feed(base, incoming, "id", [F.col("updated").desc()], gone)
    assert {row["id"] for row in feed.collect()} == {"1", "3", "7", "100"}
    after = upsert.apply_feed(base, feed, "id")
    assert after.count() == 100
    feed.write.parquet(str(tmp_path / "feed"))
    snapshot, kept = (spark.read.parquet(str(tmp_path / name)) for name in ("stats", "feed"))
    folded = stats.fold_stats(snapshot, stats.stats_delta(kept))
    assert sorted(folded.collect(), key=str) == sorted(stats.storage_stats(after).collect(), key=str)
    assert {Path(file).parent.name for file in folded.inputFiles()} == {"stats", "feed"}
    with pytest.raises(Exception, match="more than there was"):
        wrong = kept.unionByName(kept).unionByName(kept).where("after IS NULL")
        stats.fold_stats(snapshot.where("metric = 'project'").withColumn("n", F.lit(1).cast("long")), stats.stats_delta(wrong)).collect()


# --- sketches ------------------------------------------------------------------


def test_sketches_over_spans(spark, tmp_path):
    history = spark.range(60_000).select(
        F.concat(F.lit("K-"), (F.col("id") % 20_000)).alias("issue_key"), F.concat(F.lit("u"), F.col("id") % 700).alias("author_account_id"),
        (F.lit(T).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int") * 4)).alias("change_timestamp"),
    )
    kept = sketches.save_sketches(history, str(tmp_path / "sketches"))
    for span in (None, DateRange("2024-02-01", "2024-03-31 23:59:59.999999"), DateRange("2024-01-20", "2024-04-11 12:00:00"), DateRange("2024-02-03", "2024-02-05")):
        rows = history if span is None else history.where(span.condition("change_timestamp"))
        exact, found = stats.history_stats(rows).first(), sketches.sketched_stats(kept, span, history).first()
        for name in ("total_changes", "oldest_change", "newest_change"):
            assert exact[name] == found[name]
        for name in ("unique_issues", "unique_authors"):
            assert abs(found[name] - exact[name]) <= 4 * sketches.STANDARD_ERROR * exact[name] + 1
    whole = sketches.sketched_stats(kept, DateRange("2024-02-01", "2024-02-29 23:59:59.999999"))
    assert "PartitionFilters: [isnotnull(change_month" in plan(whole) and "Range (" not in plan(whole)
    assert sketches.cut_months(DateRange("2024-02-01", "2024-03-31")) == [datetime(2024, 3, 1).date()]
    with pytest.raises(ValueError):
        sketches.sketched_stats(kept, DateRange("2024-02-03", "2024-02-05"))
    before = files(tmp_path / "sketches")
    sketches.save_sketches(history.where("month(change_timestamp) = 2"), str(tmp_path / "sketches"))
    after = files(tmp_path / "sketches")
    assert {f for f in before if "02-01" not in f} == {f for f in after if "02-01" not in f}


# --- buckets -------------------------------------------------------------------


def test_bucketed_upsert_leaves_other_folders_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    store = buckets.BucketedTable(spark, f"t_{uuid.uuid4().hex}", path, folders=8, buckets=4)
    store.create(spark.range(500).selectExpr("id", "id % 7 AS value", "1 AS version").union(spark.sql("SELECT NULL, 0L, 1")))
    before = files(path)
    rows = spark.createDataFrame([(3, 100, 2), (3, 101, 3), (9000, 5, 1), (None, 0, 9)], "id long, value long, version int")
    order = [F.col("version").desc()]
    text = plan(store.put_plan(rows, order, store.touched(rows)))
    base = text[text.index("FileScan parquet"):] if text.index("FileScan parquet") > text.index("_key") else text[:text.index("_key")]
    assert "Bucketed: true" in text and "SortMergeJoin" in text
    # The only exchanges are of the incoming rows.
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    above = []
    depth = lines[scan].index("FileScan")
    for line in reversed(lines[:scan]):
        own = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if own < depth:
            above.append(line)
            depth = own
    joined = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in above[:joined]) and base
    written = store.put(rows, order)
    after = files(path)
    assert len(written) <= 2
    untouched = {f: m for f, m in before.items() if not any(f"{buckets.FOLDER}={n}/" in f for n in written)}
    assert untouched and all(after.get(f) == m for f, m in untouched.items())
    found = {row["id"]: row["value"] for row in store.read().collect()}
    assert len(found) == 501 and found[3] == 101 and found[9000] == 5 and found[4] == 4
    store.delete(spark.createDataFrame([(3,), (4,), (77777,)], "id long"))
    assert set(found) - {row["id"] for row in store.read().collect()} == {3, 4}
    store.delete(store.read().select("id"))
    assert store.read().count() == 0


# --- curve ---------------------------------------------------------------------


def test_curve_lets_three_filters_skip_files(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("P"), F.xxhash64("id") % 9).alias("project_key"),
        (F.lit(T).cast("timestamp_ntz") + F.make_dt_interval(mins=F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500_000)).cast("int"))).alias("created"),
        F.when(F.col("id") % 50 != 0, F.lit(T).cast("timestamp_ntz") + F.make_dt_interval(mins=F.pmod(F.xxhash64("id", F.lit(2)), F.lit(500_000)).cast("int"))).alias("updated"),
    ).withColumn("project_key", F.when(F.col("id") != "7", F.col("project_key")))
    found = curve.compact_on_curve(rows, str(tmp_path / "curve"), partitions=32)
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.collect()))
    parts = sorted((tmp_path / "curve").glob("*.parquet"))

    def holding(column, low, high):
        held = 0
        for part in parts:
            groups = pq.ParquetFile(part).metadata
            at = next(i for i in range(groups.num_columns) if groups.schema.column(i).name == column)
            spans = [groups.row_group(g).column(at).statistics for g in range(groups.num_row_groups)]
            held += any(s.has_min_max and s.min <= high and s.max >= low for s in spans)
        return held

    early, late = T + timedelta(days=10), T + timedelta(days=20)
    assert len(parts) == 32
    assert holding("project_key", "P3", "P3") <= 20
    assert holding("created", early, late) <= 20 and holding("updated", early, late) <= 20


def test_curve_of_empty_and_equal_rows(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), None, T, None) for i in range(10)], "id string, project_key string, created timestamp_ntz, updated timestamp_ntz")
    assert curve.compact_on_curve(rows, str(tmp_path / "equal"), partitions=2).count() == 10
    assert curve.compact_on_curve(rows.limit(0), str(tmp_path / "none"), partitions=2).count() == 0


# --- text index ------------------------------------------------------------------


def test_index_finds_what_the_plain_search_finds(spark, tmp_path):
    texts = ["50% off_now", "Straße ÄÖÜ", "STRASSE äöü", "", None, "ab", "日本語テキスト", "a%b_c", "aXbYc", "x" * 50_000 + "needle", "İstanbul"]
    issues = spark.createDataFrame([(i, t, "P") for i, t in enumerate(texts)], "id long, description string, project_key string")
    index = text_index.build_index(issues, "description", str(tmp_path / "index"))
    from trackmill.functions.text import contains_text

    for term in ("50%", "off_", "äöü", "STRASSE", "straße", "本語テ", "%b_", "ab", "a", "", "xxxneedle", "nowhere", "İst", "off_now"):
        plain = issues.where(contains_text(F.col("description"), term))
        assert sorted(index.search(issues, term).collect()) == sorted(plain.collect()), term
    assert index.candidates("ab") is None and index.candidates("nowhere").count() == 0
    assert {row["id"] for row in index.candidates("äöü").collect()} == {1, 2}


def test_index_is_built_in_one_pass_over_the_texts(spark, tmp_path, monkeypatch):
    issues = spark.createDataFrame([(1, "a😀bc"), (2, None), (3, "ab")], "id long, description string")
    assert [r[0] for r in issues.orderBy("id").select(text_index.grams(F.col("description"))).collect()] == [["a😀b", "😀bc"], None, []]
    plans, save = [], text_index.save_table
    monkeypatch.setattr(text_index, "save_table", lambda df, *a: (plans.append(df._jdf.queryExecution().toString()), save(df, *a)))
    text_index.build_index(issues, "description", str(tmp_path / "index"))
    assert "rangepartitioning" not in plans[0]


# --- stored order ----------------------------------------------------------------


def test_a_page_reads_the_files_it_lies_in(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id"), (F.pmod(F.xxhash64("id"), F.lit(50))).alias("v"))
    order = [F.col("v").desc(), F.col("id")]
    stored = sorted_files.save_sorted(rows.repartition(5), order, str(tmp_path / "sorted"), 8)
    every = rows.orderBy(*order).collect()
    assert len(files(tmp_path / "sorted/rows")) == 8
    for limit, offset in ((10, 0), (20, 495), (1, 999), (10, 1000), (50, 990), (None, 700), (None, 0), (0, 5)):
        page = stored.page(limit, offset)
        assert page.collect() == every[offset:None if limit is None else offset + limit]
        if limit is not None and limit <= 20:
            assert len([f for f in page.inputFiles() if "/rows/" in f]) <= 2
    assert sorted_files.save_sorted(rows.limit(0), order, str(tmp_path / "none"), 2).page(5).count() == 0


# --- marks by project --------------------------------------------------------------

STATE = "id string, issue_key string, project_key string, created timestamp_ntz, updated timestamp_ntz"


def test_a_failed_project_alone_keeps_its_mark(spark):
    day = lambda n: T + timedelta(days=n)
    source = spark.createDataFrame([(f"{p}{i}", f"{p}-{i}", p, day(0), day(i)) for p in "ABC" for i in range(10)] + [("n", "n", None, day(0), day(9))], STATE)
    known = source.limit(0)
    runs = spark.createDataFrame([("A", 1, day(2), True), ("B", 4, day(6), True), ("B", 5, day(7), False)], "project_key string, run_id long, end_time timestamp_ntz, is_success boolean")
    failed = spark.createDataFrame([("A", "down"), ("A", "still down")], "project_key string, error_message string")
    one = project_sync.run_by_project(source, known, runs, day(9), failed)
    assert {row["id"] for row in one.fetched.collect()} == {"B6", "B7", "B8", "B9", "C8", "C9", "n"}
    told = {row["project_key"]: row for row in one.record.collect()}
    assert (told["A"]["is_success"], told["A"]["start_time"], told["A"]["error_message"], told["A"]["synced_count"]) == (False, day(2), "down", 0)
    assert (told["B"]["run_id"], told["B"]["start_time"], told["B"]["new_count"]) == (6, day(6), 4)
    two = project_sync.run_by_project(source, one.merged, one.runs, day(10))
    assert {row["id"] for row in two.fetched.collect()} == {f"A{i}" for i in range(2, 10)}
    third = {row["project_key"]: row["start_time"] for row in project_sync.run_by_project(source, two.merged, two.runs, day(11)).record.collect()}
    assert third == {"A": day(10), "B": day(10), "C": day(10)}


def test_fetching_by_project_bounds_the_scan(spark, tmp_path):
    spark.createDataFrame([("1", "k", "A", T, T)], STATE).write.parquet(str(tmp_path / "issues"))
    known_marks = spark.createDataFrame([("A", T)], "project_key string, since timestamp_ntz")
    text = plan(project_sync.fetch_by_project(spark.read.parquet(str(tmp_path / "issues")), known_marks, T + timedelta(days=3)))
    assert "GreaterThanOrEqual(created,2024-01-01" in text and "NestedLoop" not in text


def test_streamed_marks(spark, tmp_path):
    schema = "project_key string, end_time timestamp, is_success boolean"
    at = lambda minutes: T + timedelta(minutes=minutes)
    batches = [
        [("A", at(0), True), ("A", at(5), False), ("B", at(1), True), (None, at(2), True), ("E", at(3), False)],
        [("A", at(90), True), ("C", at(100), True), ("A", at(20), True), ("A", at(90), True)],
        [("D", at(200), True), ("C", at(150), False)],
    ]
    results = []
    for way in ("one", "many"):
        path = str(tmp_path / way)
        groups = batches if way == "many" else [sum(batches, [])]
        for rows in groups:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = drops(spark, path, spark.read.parquet(path).schema, "end_time", files_per_trigger=1)
        told = run_to_end(marks.project_mark_stream(stream, 60, "10 minutes"), str(tmp_path / f"out-{way}"), str(tmp_path / f"cp-{way}"))
        results.append(sorted(tuple(r) for r in marks.marks_of(told).collect()))
    assert results[0] == results[1] == [("A", at(90), True), ("B", at(1), True), ("C", at(100), True), ("D", at(200), False)]
