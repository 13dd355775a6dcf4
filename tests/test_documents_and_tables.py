import gzip
import json

import pytest
from generated import T0, number
from pyspark.sql import functions as F

from trackmill.functions.text import decoded_text
from trackmill.operators.changelog import as_history, changelog_quarantine, parse_changelog
from trackmill.sources import landing, tables
from trackmill.streaming import incremental as streams


def issue(**changes):
    fields = {
        "summary": "Ink leaks", "description": "Plain text", "customfield_77": "teal", "labels": ["x", "y"],
        "issuetype": {"id": "1", "name": "Blot", "self": "u"},
        "priority": {"id": "3", "name": "Mild", "self": "u"},
        "status": {"id": "1", "name": "Waiting", "self": "u",
                   "statusCategory": {"id": 2, "key": "idle", "name": "Waiting", "colorName": "plum"}},
        "reporter": {"accountId": "a", "displayName": "Ann", "self": "u"}, "assignee": None,
        "created": "2024-01-01T00:00:00.000Z", "updated": "2024-01-02T00:00:00.000+0000",
    }
    fields.update(changes)
    return {"id": "9317", "key": "PRESS-4", "self": "u", "fields": {k: v for k, v in fields.items() if v != "absent"}}


def documents(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "raw_json string")


def test_flatten(spark):
    row = landing.flatten_issues(documents(spark, issue())).collect()[0]
    assert (row.id, row.issue_key, row.description, row.status_name) == ("9317", "PRESS-4", "Plain text", "Waiting")
    assert row.project_key is None and row.assignee_display_name is None
    assert str(row.updated) == "2024-01-02 00:00:00"


def test_rich_text_description(spark):
    rich = {"type": "doc", "text": "Hello"}
    row = landing.flatten_issues(documents(spark, issue(description=rich))).collect()[0]
    assert json.loads(row.description) == rich
    values = spark.createDataFrame([('"plain"',), ('{"a":1}',), ("null",)], "j string")
    texts = [r[0] for r in values.select(decoded_text(F.parse_json("j"))).collect()]
    assert texts == ["plain", '{"a":1}', None]


@pytest.mark.parametrize("bad, reason", [
    ("{broken", "malformed document"),
    (issue(summary="absent"), "missing or malformed fields.summary"),
    (issue(updated="yesterday"), "missing or malformed fields.updated"),
    (issue(priority={"id": "1", "self": "u"}), "missing or malformed fields.priority.name"),
    (issue(status={"id": "1", "name": "x", "self": "u"}), "missing or malformed fields.status.statusCategory"),
])
def test_bad_documents_go_to_quarantine(spark, bad, reason):
    docs = documents(spark, issue(), bad)
    assert landing.rehydrate(docs).count() == 1
    assert [r.reason for r in landing.issue_quarantine(docs).collect()] == [reason]


def test_custom_fields_and_labels(spark):
    row = landing.with_custom_fields(landing.flatten_issues(documents(spark, issue(extra={"a": [1]})))).collect()[0]
    assert row.custom_fields == {"customfield_77": "teal", "labels": '["x","y"]', "extra": '{"a":[1]}'}
    assert row.labels == ["x", "y"]


def test_pages(spark, tmp_path):
    page = {"startAt": 0, "maxResults": 50, "total": 2, "issues": [issue(), issue(summary="Second")]}
    (tmp_path / "p1.json").write_text(json.dumps(page, indent=2))
    (tmp_path / "p2.json").write_text('{"startAt": 50}')
    pages = landing.read_pages(spark, str(tmp_path), multi_line=True)
    assert landing.flatten_issues(landing.page_issues(pages)).count() == 2
    assert landing.bad_pages(pages).count() == 1


def test_issue_files(spark, tmp_path):
    with gzip.open(tmp_path / "issues.json.gz", "wt") as out:
        json.dump([issue(), issue(summary="Second")], out, indent=2)
    array = landing.read_issue_documents(spark, str(tmp_path), "array")
    assert landing.flatten_issues(array).count() == 2
    target = str(tmp_path / "lines")
    assert tables.save_documents(array, target) == 2
    assert landing.flatten_issues(landing.read_issue_documents(spark, target)).count() == 2
    assert landing.read_issue_documents(spark, str(tmp_path / "missing")).count() == 0
    with pytest.raises(ValueError):
        landing.read_issue_documents(spark, target, "csv")


def test_dimensions_and_users(spark, tmp_path):
    users = [{"accountId": "1", "displayName": "Ann Lee", "self": "u"}, {"accountId": "2", "displayName": "Bob", "emailAddress": "bob@lee.example", "self": "u"}]
    (tmp_path / "users.json").write_text(json.dumps(users))
    loaded = landing.read_dimension(spark, str(tmp_path), "user")
    assert loaded.count() == 2
    assert landing.search_users(loaded, "LEE").count() == 2
    assert landing.search_users(loaded, "ann").count() == 1
    assert landing.read_dimension(spark, str(tmp_path / "none"), "field").count() == 0


# --- change logs -------------------------------------------------------------

ENTRY = {"id": "c-81", "created": "2023-11-08T07:05:09.250+0000", "items": [
    {"field": "severity", "from": "s2", "to": "s4", "fromString": "Minor", "toString": "Grave"}]}


def changelogs(spark, *logs):
    rows = [("1", "T-1", log if isinstance(log, str) else json.dumps(log)) for log in logs]
    return spark.createDataFrame(rows, "issue_id string, issue_key string, changelog string")


def test_changelog(spark):
    author = {"accountId": "u", "displayName": "Ann"}
    two = [{"field": "a", "from": None, "to": "x"}, {"field": "b", "fieldId": "cf"}]
    rows = parse_changelog(changelogs(spark, {"histories": [dict(ENTRY, author=author), dict(ENTRY, items=two)]})).collect()
    assert len(rows) == 3
    assert (rows[0].author_display_name, rows[0].from_display_value, rows[0].to_value) == ("Ann", "Minor", "s4")
    assert [(r.field_name, r.from_value, r.field_id, r.author_account_id) for r in rows[1:]] == [("a", None, None, None), ("b", None, "cf", None)]


@pytest.mark.parametrize("entry, violation", [
    (dict(ENTRY, id=7), "no-change-id"),
    (dict(ENTRY, created="2023-11-08"), "bad-time"),
    ({k: v for k, v in ENTRY.items() if k != "created"}, "no-time"),
    (dict(ENTRY, author={"displayName": "Ann"}), "author-incomplete"),
    (dict(ENTRY, items=7), "no-items"),
    (dict(ENTRY, items=[{"from": "1"}]), "field-unnamed"),
])
def test_changelog_violations(spark, entry, violation):
    logs = changelogs(spark, {"histories": [ENTRY, entry]})
    assert parse_changelog(logs).count() == 1
    assert [r.violation for r in changelog_quarantine(logs).collect()] == [violation]
    with pytest.raises(Exception, match=violation):
        parse_changelog(logs, mode="strict").count()
    # In mode ``issue`` the log goes as a whole, and no other.
    both = logs.union(changelogs(spark, {"histories": [ENTRY]}))
    assert parse_changelog(both, mode="issue").count() == 1


def test_changelog_edges(spark):
    assert parse_changelog(changelogs(spark, {"histories": []}, {"histories": [dict(ENTRY, items=[])]})).count() == 0
    assert changelog_quarantine(changelogs(spark, {"histories": []})).count() == 0
    assert changelog_quarantine(changelogs(spark, {}, "junk")).count() == 2
    assert parse_changelog(changelogs(spark, {"histories": [ENTRY]}), mode="strict").count() == 1
    with pytest.raises(ValueError):
        parse_changelog(changelogs(spark, {}), mode="other")


# --- tables ------------------------------------------------------------------


def test_history_append_is_idempotent(spark, tmp_path):
    rows = as_history(parse_changelog(changelogs(spark, {"histories": [ENTRY, dict(ENTRY, id="2")]})), T0)
    path = str(tmp_path / "history")
    assert tables.append_history(rows, path) == 2
    assert tables.append_history(rows, path) == 0
    more = as_history(parse_changelog(changelogs(spark, {"histories": [ENTRY, dict(ENTRY, id="3")]})), T0)
    assert tables.append_history(more, path) == 1
    assert tables.append_history(rows, path, only_new=False) == 2
    assert spark.read.parquet(path).count() == 5
    assert tables.overwrite_history(rows, path) == 2
    assert spark.read.parquet(path).count() == 2


def test_json_overwrite_and_compaction(spark, issues, tmp_path):
    path = str(tmp_path / "json")
    of_one = number(lambda i: i.project_key == "PRESS1")
    assert tables.save_json(issues, path) == 500
    assert tables.save_json(issues.where("project_key = 'PRESS1'"), path) == of_one
    assert spark.read.schema(issues.schema).json(path).count() == of_one
    compacted = tables.compact(issues, str(tmp_path / "compact"))
    assert compacted.exceptAll(issues).count() == 0 and compacted.count() == 500
    assert tables.save_stats(issues, str(tmp_path / "stats")).where("metric = 'total'").collect()[0].n == 500


def test_analyze(spark, issues):
    issues.limit(10).write.mode("overwrite").saveAsTable("some_issues")
    tables.analyze(spark, "some_issues")
    details = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED some_issues").collect()}
    assert "10 rows" in details["Statistics"]


def test_change_table(spark, tmp_path):
    store = tables.ChangeTable(spark, str(tmp_path / "base"), str(tmp_path / "changes"))
    assert store.current() is None
    shape = "id string, status string, updated int"
    batch = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", "a", 1)], shape)
    store.take_in(batch, 0)
    store.take_in(batch, 0)
    assert {r.id: r.status for r in store.current().collect()} == {"1": "b", "2": "a"}
    store.take_in(spark.createDataFrame([("2", "z", 1)], shape), 1)
    # An older version that arrives later, and batch 0 of another source, replace nothing.
    store.take_in(spark.createDataFrame([("1", "old", 0)], shape), 2)
    store.take_in(spark.createDataFrame([("3", "c", 5)], shape), 0, "other")
    compacted = store.compact_to(str(tmp_path / "base2"))
    assert {r.id: r.status for r in compacted.collect()} == {"1": "b", "2": "z", "3": "c"}
    # A base row that is newer than a batch stays.
    late = tables.ChangeTable(spark, str(tmp_path / "base2"), str(tmp_path / "late"))
    late.take_in(spark.createDataFrame([("1", "older", 1), ("2", "same", 1)], shape), 0)
    assert {r.id: r.status for r in late.current().collect()} == {"1": "b", "2": "same", "3": "c"}


@pytest.mark.parametrize("turned", [False, True])
def test_position_decides_between_equal_versions(spark, tmp_path, turned):
    rows = [("1", "first", 7, 1), ("1", "second", 7, 2)]
    batch = spark.createDataFrame(rows[::-1] if turned else rows, "id string, status string, updated int, landed int")
    store = tables.ChangeTable(spark, str(tmp_path / "base"), str(tmp_path / "changes"), position="landed")
    store.take_in(batch.coalesce(1), 0)
    assert [r.status for r in store.current().collect()] == ["second"]


def test_streams(spark, tmp_path):
    events = spark.range(1000).select(
        "id", (F.lit(T0).cast("timestamp_ntz") + F.make_interval(mins=F.col("id").cast("int"))).alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("x").alias("kind"))
    drop = str(tmp_path / "drop")
    events.where("id < 600").write.parquet(f"{drop}/d=1")
    events.where("id >= 500").write.parquet(f"{drop}/d=2")
    stream = streams.drops(spark, drop, events.schema, "ts")
    unique = streams.deduplicated(stream, "id", "ts", "30 days")
    out = streams.run_to_end(unique, str(tmp_path / "u"), str(tmp_path / "uc"))
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000
    again = streams.run_to_end(unique, str(tmp_path / "u"), str(tmp_path / "uc"))
    assert again.count() == 1000
    hot = streams.deduplicated(stream, "kind", "ts", "30 days", repeated=True)
    assert streams.run_to_end(hot, str(tmp_path / "h"), str(tmp_path / "hc")).count() == 2
    store = tables.ChangeTable(spark, str(tmp_path / "base"), str(tmp_path / "ch"), version="ts")
    late = streams.LateRows()
    spark.streams.addListener(late)
    query = streams.upsert_stream(stream, store, str(tmp_path / "cc"))
    query.awaitTermination()
    spark.streams.removeListener(late)
    assert store.current().count() == 1000
    assert set(late.by_query.values()) <= {0}


def test_judging_documents_leaves_methods_short_enough_to_compile(spark):
    """The JVM compiles no method of more than 8000 bytes."""
    docs = documents(spark, issue()).repartition(2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (landing.issue_quarantine(docs), landing.rehydrate(docs), landing.flatten_issues(docs)):
            stages = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
            assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_doubtful_logs_are_found_without_a_search_for_escapes_in_each(spark):
    logs = ['{"histories": [{"id" : 7}]}', '{"histories": [{"\\u0069d": 7}]}', '{"histories": [{"id": "\\u0069d"}]}', '{"histories": [{"x": 7}]}']
    rows = spark.createDataFrame([(str(i), "K", log) for i, log in enumerate(logs)], "issue_id string, issue_key string, changelog string")
    bad = changelog_quarantine(rows)
    assert [r.violation for r in bad.orderBy("issue_id").collect()] == ["no-change-id", "no-change-id", "no-time", "no-change-id"]
    assert "Contains(changelog" in bad._jdf.queryExecution().optimizedPlan().toString()


def test_scanned_pages_are_landed_compressed(spark, tmp_path, monkeypatch):
    from trackmill.plans import landing_queries

    monkeypatch.setattr(landing_queries, "issue_documents", lambda *_: documents(spark, issue()))
    monkeypatch.setattr(landing_queries, "scratch_path", lambda *_: str(tmp_path / "pages"))
    assert landing_queries.scan_pages(spark, "").count() == 1
    assert {p.suffix for p in (tmp_path / "pages").glob("part-*")} == {".gz"}
