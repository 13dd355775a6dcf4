"""Queries on what a store keeps up beside its rows: digests, statistics, sketches, buckets,
curves, postings and offsets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trackmill.functions.instants import instant
from trackmill.operators import digests, stats, upsert
from trackmill.operators.filters import DateRange, IssueFilter
from trackmill.operators.ordering import issue_order
from trackmill.plans.registry import query
from trackmill.plans.standins import (
    HISTORY_SQL,
    ISSUES_SQL,
    OWNED_SQL,
    document_issues,
    history,
    issues,
    owned_issues,
    table,
)
from trackmill.session import durable, scratch_path
from trackmill.sources import buckets, curve, sketches, sorted_files, tables, text_index

# Two stores of the events: in the second, the users of one remainder are missing and those of
# another are there twice.
MISSING, TWICE = "user_id % 50 = 7", "user_id % 50 = 3"


@query("q_u2_digest", f"""
WITH a AS (SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id),
     b AS (SELECT user_id, COUNT(*) AS n FROM (
       SELECT user_id FROM events WHERE NOT ({MISSING}) UNION ALL SELECT user_id FROM events WHERE {TWICE}) GROUP BY user_id)
SELECT COALESCE(a.user_id, b.user_id) AS user_id, COALESCE(a.n, 0) AS left_rows, COALESCE(b.n, 0) AS right_rows
FROM a FULL JOIN b ON a.user_id = b.user_id WHERE COALESCE(a.n, 0) <> COALESCE(b.n, 0)""")
def u2_digest(spark, sf_dir):
    events, paths = table(spark, sf_dir, "events"), [scratch_path(spark, "store") for _ in range(2)]
    digests.save_by_range(events, paths[0], "user_id")
    digests.save_by_range(events.where(f"NOT ({MISSING})").union(events.where(TWICE)), paths[1], "user_id")
    return digests.reconcile_by_digest(*[spark.read.parquet(path) for path in paths], "user_id")


# Issues created by then are the stored ones; of these some get another status, some move to
# another project, some are deleted; all later issues are new.
STORED_UNTIL = "2000-06-01 00:00:00"
FED_SQL = f"""
fed AS (
  SELECT id, issue_key, CASE WHEN CAST(id AS BIGINT) % 11 = 0 AND created < TIMESTAMP '{STORED_UNTIL}' THEN 'MOVED' ELSE project_key END AS project_key,
         CASE WHEN CAST(id AS BIGINT) % 7 = 0 AND created < TIMESTAMP '{STORED_UNTIL}' THEN 'X' ELSE status_name END AS status_name, issue_type_name, created
  FROM owned_issues WHERE NOT (created < TIMESTAMP '{STORED_UNTIL}' AND CAST(id AS BIGINT) % 13 = 0))"""
FED = ("id", "issue_key", "project_key", "status_name", "issue_type_name", "created")


def fed_issues(spark, sf_dir):
    """The stored issues, the incoming ones and the keys to delete."""
    every = owned_issues(spark, sf_dir).select(*FED)
    number, old = F.col("id").cast("long"), F.col("created") < instant(STORED_UNTIL)
    changed = every.where(~old | (number % 11 == 0) | (number % 7 == 0)).withColumns({
        "project_key": F.when(old & (number % 11 == 0), "MOVED").otherwise(F.col("project_key")),
        "status_name": F.when(old & (number % 7 == 0), "X").otherwise(F.col("status_name")),
    })
    gone = every.where(old & (number % 13 == 0)).select("id")
    return every.where(old), changed.join(gone, "id", "left_anti").select(*FED), gone


@query("q_s14_delta", f"""WITH {OWNED_SQL}, {FED_SQL}
SELECT 'total' AS metric, CAST(NULL AS VARCHAR) AS key, COUNT(*) AS n FROM fed
UNION ALL SELECT 'project', project_key, COUNT(*) FROM fed WHERE project_key IS NOT NULL GROUP BY project_key
UNION ALL SELECT 'status', status_name, COUNT(*) FROM fed GROUP BY status_name
UNION ALL SELECT 'type', issue_type_name, COUNT(*) FROM fed GROUP BY issue_type_name""")
def s14_delta(spark, sf_dir):
    """Statistics of the stored issues, kept up from what an upsert and a delete changed."""
    base, incoming, gone = fed_issues(spark, sf_dir)
    snapshot = tables.save_stats(base, scratch_path(spark, "metadata"))
    feed = durable(upsert.change_feed(base, incoming, "id", [F.col("created").desc()], gone))
    return stats.fold_stats(snapshot, stats.stats_delta(feed))


@query("q_s6_feed", f"WITH {OWNED_SQL}, {FED_SQL} SELECT {', '.join(FED)} FROM fed")
def s6_feed(spark, sf_dir):
    base, incoming, gone = fed_issues(spark, sf_dir)
    feed = durable(upsert.change_feed(base, incoming, "id", [F.col("created").desc()], gone))
    return upsert.apply_feed(base, feed, "id")


@query("q_s6_bucketed", f"WITH {OWNED_SQL}, {FED_SQL} SELECT {', '.join(FED)} FROM fed")
def s6_bucketed(spark, sf_dir):
    base, incoming, gone = fed_issues(spark, sf_dir)
    store = buckets.BucketedTable(spark, f"issues_{uuid.uuid4().hex}", scratch_path(spark, "bucketed"))
    store.create(base)
    store.put(incoming, [F.col("created").desc()])
    store.delete(gone)
    return store.read()


@query("q_a7_sketch")
def a7_sketch(spark, sf_dir):
    """Estimated distinct counts over seven whole years, from the stored sketches of their months."""
    kept = sketches.save_sketches(history(spark, sf_dir), scratch_path(spark, "sketches"))
    return sketches.sketched_stats(kept, DateRange("1993-01-01", "1999-12-31 23:59:59.999999"))


PROJECT_SPAN = DateRange("1997-01-01", "1999-12-31")


@query("q_project_activity", f"""WITH {OWNED_SQL}, {HISTORY_SQL}
SELECT project_key, COUNT(*) AS changes, COUNT(DISTINCT h.issue_key) AS issues_with_history,
  COUNT(DISTINCT author_account_id) AS authors
FROM history h JOIN owned_issues i ON issue_id = i.id
WHERE project_key IN ('BUILDING', 'MACHINERY') AND change_timestamp BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31'
GROUP BY project_key""")
def project_activity(spark, sf_dir):
    return stats.project_activity(
        history(spark, sf_dir), owned_issues(spark, sf_dir), PROJECT_SPAN, ["BUILDING", "MACHINERY"]
    )


@query("q_projects_top_authors", f"""WITH {OWNED_SQL}, {HISTORY_SQL}
SELECT author_account_id, COUNT(*) AS changes, COUNT(DISTINCT h.issue_key) AS issues
FROM history h JOIN owned_issues i ON issue_id = i.id WHERE project_key IN ('BUILDING', 'MACHINERY')
GROUP BY author_account_id ORDER BY changes DESC, author_account_id LIMIT 20""")
def projects_top_authors(spark, sf_dir):
    return stats.top_authors_of(history(spark, sf_dir), owned_issues(spark, sf_dir), ["BUILDING", "MACHINERY"], 20)


@query("q_s15_curve", f"WITH {ISSUES_SQL} SELECT id, issue_key, project_key, status_name, created, updated FROM issues")
def s15_curve(spark, sf_dir):
    rows = issues(spark, sf_dir).select("id", "issue_key", "project_key", "status_name", "created", "updated")
    return curve.compact_on_curve(durable(rows), scratch_path(spark, "curve"), partitions=32)


@query("q_f10_indexed", "SELECT doc_id AS id, source AS project_key FROM documents WHERE CONTAINS(LOWER(text), 'est the')")
def f10_indexed(spark, sf_dir):
    """The search of q_f10 through a trigram index."""
    documents = document_issues(spark, sf_dir)
    index = text_index.build_index(documents, "description", scratch_path(spark, "postings"))
    return index.search(documents, "Est The").select("id", "project_key")


SHOWN = ("id", "issue_key", "summary", "created")


@query("q_o11_stored", f"""WITH {OWNED_SQL} SELECT {', '.join(SHOWN)} FROM owned_issues
ORDER BY created, issue_key, id LIMIT 150 OFFSET 1100""")
def o11_stored(spark, sf_dir):
    """A deep page from a stored order."""
    shown = owned_issues(spark, sf_dir).select(*SHOWN)
    stored = sorted_files.save_sorted(shown, issue_order(IssueFilter(sort_order="created_asc").sort_order), scratch_path(spark, "sorted"), 8)
    return stored.page(150, 1100)
