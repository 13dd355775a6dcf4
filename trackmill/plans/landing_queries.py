"""Queries of the source, sink and nested-document families.

Sinks write to a fresh path and the result is what reads back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions.text import any_column_contains
from trackmill.operators.changelog import as_history, changelog_quarantine, parse_changelog
from trackmill.operators.filters import HistoryFilter
from trackmill.operators.grouping import last_wins
from trackmill.operators.ordering import load_history
from trackmill.operators.upsert import deleted_rows
from trackmill.functions.changes import author_struct
from trackmill.plans.registry import query
from trackmill.plans.standins import (
    CHANGELOG_SQL,
    HISTORY_SQL,
    HISTORY_TIES,
    ISSUES_SQL,
    changelog_documents,
    history,
    issue_document,
    issue_documents,
    issue_rows,
    owned_issues,
    result_pages,
    table,
)
from trackmill.plans.stat_queries import STORAGE_STATS_SQL
from trackmill.schemas import ISSUE_DOCUMENT
from trackmill.session import durable, scratch_path
from trackmill.sources import arrays, landing, tables

FLAT = (
    "id", "issue_key", "summary", "status_name", "priority_name", "issue_type_name", "project_key",
    "reporter_display_name", "assignee_display_name", "created", "updated", "resolution_date",
)
# Documents without a change have no update time and stay out.
VALID_SQL = f"WITH {ISSUES_SQL} SELECT {', '.join(FLAT)} FROM issues SEMI JOIN last_change ON id = change_of"
TIMES = ("created", "updated", "resolution_date")


def _zoneless(df, *names):
    """Zone-less UTC timestamps, as the tables have them."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


@query("q_scan_pages", VALID_SQL)
def scan_pages(spark, sf_dir):
    path = scratch_path(spark, "pages")
    result_pages(issue_documents(spark, sf_dir), 100).write.option("compression", "gzip").text(path)
    scanned = landing.page_issues(landing.read_pages(spark, path))
    return _zoneless(landing.flatten_issues(scanned).select(*FLAT), *TIMES)


@query("q_s2", f"WITH {ISSUES_SQL} SELECT id, issue_key FROM issues")
def s2(spark, sf_dir):
    path = scratch_path(spark, "documents")
    tables.save_documents(issue_documents(spark, sf_dir), path)
    read = landing.read_issue_documents(spark, path)
    return read.select(
        F.get_json_object("raw_json", "$.id").alias("id"),
        F.get_json_object("raw_json", "$.key").alias("issue_key"),
    )


@query("q_s3", f"WITH {ISSUES_SQL} SELECT id, issue_key, summary, created FROM issues")
def s3(spark, sf_dir):
    path = scratch_path(spark, "issues-json")
    rows = owned_issues(spark, sf_dir).select("id", "issue_key", "summary", "created")
    tables.save_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("q_flatten_issues", VALID_SQL)
def flatten(spark, sf_dir):
    flat = landing.flatten_issues(issue_documents(spark, sf_dir))
    return _zoneless(flat.select(*FLAT), *TIMES)


@query("q_rehydrate", f"""WITH {ISSUES_SQL} SELECT id, status_name, issue_type_name, project_key,
  priority_name FROM issues SEMI JOIN last_change ON id = change_of""")
def rehydrate(spark, sf_dir):
    typed = landing.rehydrate(issue_documents(spark, sf_dir))
    return typed.select(
        "issue.id", F.col("issue.fields.status.name").alias("status_name"),
        F.col("issue.fields.issuetype.name").alias("issue_type_name"),
        F.col("issue.fields.project.key").alias("project_key"),
        F.col("issue.fields.priority.name").alias("priority_name"),
    )


@query("q_issue_quarantine", f"""WITH {ISSUES_SQL} SELECT id,
  'missing or malformed fields.updated' AS reason FROM issues ANTI JOIN last_change ON id = change_of""")
def quarantine(spark, sf_dir):
    bad = landing.issue_quarantine(issue_documents(spark, sf_dir))
    return bad.select(F.get_json_object("raw_json", "$.id").alias("id"), "reason")


@query("q_s6", """SELECT user_id AS id, ARG_MAX(event_type, ts) AS event_type, MAX(ts) AS updated
FROM events GROUP BY user_id""")
def s6(spark, sf_dir):
    base, changes = scratch_path(spark, "base"), scratch_path(spark, "changes")
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), "event_type", F.col("ts").alias("updated")
    )
    store = tables.ChangeTable(spark, base, changes)
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    tables.save_table(last_wins(events.where(F.col("updated") < middle), ["id"], [F.col("updated").desc()]), base)
    store.take_in(events.where(F.col("updated") >= middle), 0)
    return store.current()


@query("q_s8", f"WITH {HISTORY_SQL} SELECT issue_key, change_id, change_timestamp FROM history")
def s8(spark, sf_dir):
    path = scratch_path(spark, "history")
    rows = history(spark, sf_dir).withColumn("item_pos", F.lit(0))
    early = rows.where(F.col("change_timestamp") < F.lit("1999-01-01").cast("timestamp_ntz"))
    tables.append_history(early, path)
    tables.append_history(rows, path)
    return spark.read.parquet(path).select("issue_key", "change_id", "change_timestamp")


@query("q_s9", f"WITH {HISTORY_SQL} SELECT issue_key, change_id, change_timestamp FROM history")
def s9(spark, sf_dir):
    path = scratch_path(spark, "history")
    tables.overwrite_history(history(spark, sf_dir), path)
    return spark.read.parquet(path).select("issue_key", "change_id", "change_timestamp")


@query("q_s10", f"""WITH {HISTORY_SQL} SELECT issue_key, change_id, change_timestamp,
  CASE WHEN author_display_name IS NOT NULL THEN author_account_id END AS account_id
FROM history WHERE field_name = 'priority'
ORDER BY change_timestamp, issue_key, change_id, field_name LIMIT 500""")
def s10(spark, sf_dir):
    spec = HistoryFilter(field_names=["priority"], limit=500, sort_order="timestamp_asc")
    loaded = load_history(history(spark, sf_dir), spec, HISTORY_TIES)
    return loaded.select(
        "issue_key", "change_id", "change_timestamp",
        author_struct().getField("account_id").alias("account_id"),
    )


@query("q_s11", f"""WITH {HISTORY_SQL} SELECT COUNT(*) AS removed FROM history
WHERE author_account_id IN (SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal < 0)""")
def s11(spark, sf_dir):
    everything = history(spark, sf_dir).select("author_account_id")
    gone = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0).select(
        F.concat(F.lit("S"), "s_suppkey").alias("author_account_id")
    )
    return deleted_rows(everything, gone, "author_account_id").agg(F.count("*").alias("removed"))


@query("q_s12", """SELECT 'user' AS kind, COUNT(*) AS n, COUNT(DISTINCT c_name) AS names FROM customer
UNION ALL SELECT 'project', COUNT(*), COUNT(DISTINCT n_name) FROM nation
UNION ALL SELECT 'priority', COUNT(*), COUNT(DISTINCT o_orderpriority)
  FROM (SELECT DISTINCT o_orderpriority FROM orders)
UNION ALL SELECT 'issue_type', COUNT(*), COUNT(DISTINCT p_type) FROM (SELECT DISTINCT p_type FROM part)
UNION ALL SELECT 'field', COUNT(*), COUNT(DISTINCT event_type) FROM (SELECT DISTINCT event_type FROM events)
UNION ALL SELECT 'status_category', COUNT(*), COUNT(DISTINCT r_name) FROM region""")
def s12(spark, sf_dir):
    def named(source, column):
        return table(spark, sf_dir, source).select(F.col(column).alias("name"))

    lists = {
        "user": named("customer", "c_name"),
        "project": named("nation", "n_name"),
        "priority": named("orders", "o_orderpriority").distinct(),
        "issue_type": named("part", "p_type").distinct(),
        "field": named("events", "event_type").distinct(),
        "status_category": named("region", "r_name"),
    }
    counted = None
    for kind, names in lists.items():
        path = scratch_path(spark, kind)
        label = "displayName" if kind == "user" else "name"
        names.select(F.col("name").alias("key"), F.col("name").alias(label)).write.json(path)
        landed = landing.read_dimension(spark, path, kind, multi_line=False)
        part = landed.agg(
            F.lit(kind).alias("kind"), F.count("*").alias("n"), F.count_distinct(label).alias("names")
        )
        counted = part if counted is None else counted.unionByName(part)
    return counted.select("kind", "n", "names")


@query("q_s12_quarantine", """SELECT 'read' AS kind, COUNT(DISTINCT c_mktsegment) AS n FROM customer
UNION ALL SELECT 'broken', 1""")
def s12_quarantine(spark, sf_dir):
    """Segments as a priority list, beside a file that was cut off while it was written."""
    path = scratch_path(spark, "priorities")
    names = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name")).distinct()
    names.select("name", F.lit("u").alias("self"), F.col("name").alias("id")).write.json(path)
    spark.createDataFrame([('[{"id": "1", "na',)], "value string").coalesce(1).write.mode("append").text(path)
    read = landing.read_dimension(spark, path, "priority", multi_line=False)
    broken = landing.dimension_quarantine(spark, path, "priority", multi_line=False)
    return read.agg(F.lit("read").alias("kind"), F.count("*").alias("n")).unionByName(
        broken.agg(F.lit("broken").alias("kind"), F.count("*").alias("n"))
    )


@query("q_s2_array", f"""WITH {ISSUES_SQL}
SELECT 'read' AS kind, COUNT(*) AS n FROM issues WHERE id IN (SELECT change_of FROM last_change)
UNION ALL SELECT 'broken', COUNT(*) + 1 FROM issues WHERE id NOT IN (SELECT change_of FROM last_change)""")
def s2_array(spark, sf_dir):
    """Issues landed as arrays, one array per line, beside a file that was cut off."""
    path = scratch_path(spark, "arrays")
    pages = result_pages(issue_documents(spark, sf_dir), 200)
    arrays = pages.select(F.get_json_object("value", "$.issues").alias("value"))
    # Each task writes one file and one reads it; the fastest level already makes a tenth of the text.
    arrays.write.options(lineSep="\n", compression="gzip", **{"zlib.compress.level": "BEST_SPEED"}).text(path)
    spark.createDataFrame([('[{"id": "1", "fie',)], "value string").coalesce(1).write.mode("append").text(path)
    found = landing.read_issue_documents(spark, path, "array_lines")
    return landing.rehydrate(found).agg(F.lit("read").alias("kind"), F.count("*").alias("n")).unionByName(
        landing.issue_quarantine(found).agg(F.lit("broken").alias("kind"), F.count("*").alias("n"))
    )


# Records of an array file, some; array files of a wave; and the text of a block, nine or ten of which are a file.
RECORDS, WAVE, BLOCK_BYTES = 50_000, 24, 8 << 20


def array_files(documents, path, files, document=None, first=0, compression="bzip2"):
    """Documents as pretty-printed arrays, dealt over so many files, each written by a task over what
    is at the path, plain or compressed so that its blocks can be read apart.  The rows are dealt before ``document``
    makes text of them, by default their ``raw_json``.  Of every thousandth the last bracket is
    missing; the first file, numbered 0, has one more, of another kind, and the others end in a comma."""
    numbers = documents.sparkSession.range(files).withColumn("file", F.col("id").cast("int"))
    last = F.when(F.col("file") + first == 0, '  {\n    "id" : "last, [of all] \\"{"\n  }\n]').otherwise("]")
    around = [numbers.select("file", F.lit(0).alias("at"), F.lit("[").alias("around")),
              numbers.select("file", F.lit(2).alias("at"), last.alias("around"))]
    file = F.pmod(F.xxhash64(*documents.columns), F.lit(files)).cast("int")
    parts = documents.select("*", file.alias("file"), F.lit(1).alias("at"))
    for rows in around:
        parts = parts.unionByName(rows, allowMissingColumns=True)
    dealt = parts.repartitionById(files, F.col("file")).sortWithinPartitions("at")
    made = dealt.select("at", "around", (F.col("raw_json") if document is None else document).alias("raw_json"))
    made = made.withColumn("typed", F.from_json("raw_json", ISSUE_DOCUMENT))
    text = F.to_json("typed", {"pretty": "true"})
    text = F.concat(F.lit("  "), F.replace(text, F.lit("\n"), F.lit("\n  ")))
    cut = F.col("typed.id").cast("long") % 1000 == 7
    text = F.concat(F.when(cut, F.regexp_replace(text, r"\}\s*$", "")).otherwise(text), F.lit(","))
    lines = made.select(F.when(F.col("at") == 1, text).otherwise(F.col("around")).alias("value"))
    lines.write.mode("overwrite").option("compression", compression).text(path)


@query("q_s2_split", f"""WITH {ISSUES_SQL}, marked AS (
  SELECT id, CAST(id AS BIGINT) % 1000 = 7 AS cut, id IN (SELECT change_of FROM last_change) AS changed FROM issues)
SELECT id, CASE WHEN cut THEN 'malformed document' WHEN changed THEN 'read' ELSE 'missing or malformed fields.updated' END AS outcome
FROM marked UNION ALL SELECT 'last, [of all] "{{', 'missing or malformed key'""")
def s2_split(spark, sf_dir):
    """Array files of some 50,000 records, each read in blocks by many tasks; records cut off spoil no other.

    The files land and are read in waves, each over the one before: as plain text all together would be many times
    the tables, and compressed so that they can be split they take many times as long."""
    path, stored, outcomes = (scratch_path(spark, label) for label in ("array", "array-rows", "array-outcomes"))
    files = table(spark, sf_dir, "orders").count() // RECORDS + 1
    waves = -(-files // WAVE)
    rows = issue_rows(spark, sf_dir)
    rows = rows.withColumn("wave", F.pmod(F.hash(*rows.columns), F.lit(waves)))
    rows.write.partitionBy("wave").option("compression", "zstd").parquet(stored)
    rows = spark.read.schema(rows.schema).parquet(stored)
    for wave in range(waves):
        first, end = files * wave // waves, files * (wave + 1) // waves
        landed = rows.where(F.col("wave") == wave).drop("wave")
        array_files(landed, path, end - first, issue_document(), first, "none")
        judged = landing.judge(arrays.read_arrays(spark, path, BLOCK_BYTES, f"{path}-parts"))
        own = F.regexp_replace(F.regexp_extract("raw_json", r'"id" : "((?:[^"\\]|\\.)*)"', 1), r'\\"', '"')
        id_ = F.when(F.col("reason").isNull(), F.col("issue.id")).otherwise(own)
        judged = judged.select(id_.alias("id"), F.coalesce("reason", F.lit("read")).alias("outcome"))
        judged.write.mode("append").parquet(outcomes)
    return spark.read.parquet(outcomes)


@query("q_search_users", """SELECT c_custkey, c_name FROM customer
WHERE CONTAINS(LOWER(c_name), '77') OR CONTAINS(LOWER(c_mktsegment), '77')""")
def search_users(spark, sf_dir):
    users = table(spark, sf_dir, "customer")
    return landing.search_users(users, "77", ("c_name", "c_mktsegment")).select("c_custkey", "c_name")


@query("q_s14", STORAGE_STATS_SQL)
def s14(spark, sf_dir):
    return tables.save_stats(owned_issues(spark, sf_dir), scratch_path(spark, "metadata"))


@query("q_s15", f"WITH {ISSUES_SQL} SELECT id, issue_key, project_key, status_name, created FROM issues")
def s15(spark, sf_dir):
    rows = owned_issues(spark, sf_dir).select("id", "issue_key", "project_key", "status_name", "created")
    return tables.compact(rows, scratch_path(spark, "compacted"))


# --- nested change logs ------------------------------------------------------

PARSED = (
    "issue_id", "issue_key", "change_id", "change_timestamp", "author_account_id",
    "author_display_name", "item_pos", "field_name", "field_id", "from_value", "to_value",
)


@query("q_changelog_explode", f"WITH {CHANGELOG_SQL} SELECT {', '.join(PARSED)} FROM changes")
def changelog_explode(spark, sf_dir):
    parsed = parse_changelog(changelog_documents(spark, sf_dir))
    return _zoneless(parsed.select(*PARSED), "change_timestamp")


@query("q_changelog_quarantine", f"""WITH {CHANGELOG_SQL} SELECT issue_id, issue_key,
  change_id, violation FROM entries WHERE violation IS NOT NULL""")
def changelog_bad(spark, sf_dir):
    bad = changelog_quarantine(changelog_documents(spark, sf_dir))
    return bad.select("issue_id", "issue_key", "change_id", "violation")


@query("q_changelog_whole", f"""WITH {CHANGELOG_SQL}
SELECT COUNT(*) AS n, COUNT(DISTINCT issue_key) AS issues FROM changes""")
def changelog_whole(spark, sf_dir):
    """Logs with an invalid entry are left out whole; here a log is one entry."""
    parsed = parse_changelog(changelog_documents(spark, sf_dir), mode="issue")
    return parsed.agg(F.count("*").alias("n"), F.count_distinct("issue_key").alias("issues"))


@query("q_n1", f"""WITH {CHANGELOG_SQL} SELECT field_name, COUNT(*) AS n,
  COUNT(DISTINCT issue_id) AS issues, COUNT(from_value) AS with_from FROM changes GROUP BY field_name""")
def n1(spark, sf_dir):
    rows = as_history(parse_changelog(changelog_documents(spark, sf_dir)), "2001-08-01")
    return rows.groupBy("field_name").agg(
        F.count("*").alias("n"), F.count_distinct("issue_id").alias("issues"),
        F.count("from_value").alias("with_from"),
    )


@query("q_n4", """SELECT doc_id FROM documents WHERE lang IN ('de', 'fr')
  OR CONTAINS(LOWER(source), 'web')""")
def n4(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    tags = F.array("lang", "source")
    member = F.arrays_overlap(tags, F.array(F.lit("de"), F.lit("fr")))
    return documents.where(member | any_column_contains([F.col("source")], "WEB")).select("doc_id")
