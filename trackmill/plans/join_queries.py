"""Queries of the join and set-operation families."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions.instants import instant
from trackmill.operators.chunks import covering_chunks
from trackmill.operators.joins import (
    assign_chunks,
    chunk_index,
    classify,
    exclude_known,
    join_history,
    keep_known,
    sweep_chunks,
)
from trackmill.operators.ordering import numbered
from trackmill.operators.setops import concat, overlap, reconcile, reconcile_summary
from trackmill.plans.registry import query
from trackmill.plans.standins import HISTORY_SQL, OWNED_SQL, history, owned_issues, table

# Issues created before this were fetched by an earlier run.
EARLIER = "2000-01-01 00:00:00"
EARLIER_SQL = f"TIMESTAMP '{EARLIER}'"


def _known(spark, sf_dir):
    """Keys of the customers' orders placed before the earlier run."""
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < instant(EARLIER)).select("o_custkey")


@query("q_issue_history_join", f"""WITH {OWNED_SQL}, {HISTORY_SQL}
SELECT i.id, i.issue_key, summary, change_id, field_name, to_display_value, change_timestamp,
  ROW_NUMBER() OVER (ORDER BY change_timestamp DESC, i.issue_key, change_id) AS position
FROM owned_issues i JOIN history h ON i.id = h.issue_id
WHERE project_key = 'BUILDING' AND field_name = 'status'""")
def issue_history_join(spark, sf_dir):
    return numbered(join_history(owned_issues(spark, sf_dir), history(spark, sf_dir), "BUILDING", "status"))


@query("q_exclude_existing", f"""SELECT c_custkey AS o_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders
  WHERE o_custkey = c_custkey AND o_orderdate < {EARLIER_SQL})""")
def exclude_existing(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return exclude_known(customers, _known(spark, sf_dir), "o_custkey")


@query("q_j3", """SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate FROM lineitem
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""")
def j3(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    finished = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return keep_known(lines, finished.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


@query("q_classify_new_updated", f"""
WITH known AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < {EARLIER_SQL})
SELECT o_orderkey, o_custkey, o_orderdate,
  CASE WHEN EXISTS (SELECT 1 FROM known k WHERE k.o_custkey = o.o_custkey)
    THEN 'updated' ELSE 'new' END AS sync_kind
FROM orders o WHERE o_orderdate >= {EARLIER_SQL}""")
def classify_new_updated(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    fetched = orders.where(F.col("o_orderdate") >= instant(EARLIER))
    return classify(fetched, _known(spark, sf_dir), "o_custkey")


@query("q_chunk_assign", """SELECT event_id, ts,
  LEAST(FLOOR((EPOCH_US(ts) - EPOCH_US(TIMESTAMP '2024-01-01')) / 21600000000.0), 119)::BIGINT AS chunk
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'""")
def chunk_assign(spark, sf_dir):
    chunk = chunk_index(F.col("ts"), "2024-01-01", "2024-01-31", 6)
    numbered = table(spark, sf_dir, "events").select("event_id", "ts", chunk.alias("chunk"))
    return numbered.where(F.col("chunk").isNotNull())


@query("q_j5", """
WITH span AS (SELECT MIN(o_orderdate) AS a, MAX(o_orderdate) AS b FROM orders)
SELECT o_orderkey, o_orderdate,
  LEAST((EPOCH_US(o_orderdate) - EPOCH_US(a)) // (720 * 3600000000),
        (EPOCH_US(b) - EPOCH_US(a) - 1) // (720 * 3600000000))::BIGINT AS chunk
FROM orders, span""")
def j5(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    chunks = covering_chunks(orders, "o_orderdate", 720).select("chunk", "chunk_start", "chunk_end")
    return assign_chunks(orders, chunks, "o_orderdate", ["o_orderkey"], 720).select(
        "o_orderkey", "o_orderdate", "chunk"
    )


@query("q_j5_nested", """
WITH months AS (SELECT DISTINCT DATE_TRUNC('month', o_orderdate)::TIMESTAMP AS m FROM orders),
chunks AS (
  SELECT 'month' AS kind, m AS chunk_start, m + INTERVAL 45 DAY AS chunk_end FROM months
  UNION ALL SELECT 'second', m, m + INTERVAL 1 SECOND FROM months
  UNION ALL SELECT DISTINCT 'year', DATE_TRUNC('year', m)::TIMESTAMP, DATE_TRUNC('year', m)::TIMESTAMP + INTERVAL 365 DAY FROM months
  UNION ALL SELECT 'all', (SELECT MIN(m) FROM months), (SELECT MAX(o_orderdate) FROM orders)
  UNION ALL SELECT 'empty', MIN(m), MIN(m) FROM months)
SELECT o_orderkey, o_orderdate, kind, chunk_start, chunk_end FROM orders JOIN chunks
  ON o_orderdate >= chunk_start AND (o_orderdate < chunk_end
    OR (o_orderdate = chunk_end AND chunk_end = (SELECT MAX(chunk_end) FROM chunks WHERE chunk_start < chunk_end)))""")
def j5_nested(spark, sf_dir):
    """Orders in chunks of 45 days that overlap, of a year, of a second, and of the whole span."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    begin = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    months = orders.select(begin.alias("m")).distinct()
    year = F.date_trunc("year", "m").cast("timestamp_ntz")

    def chunk(rows, kind, start, end):
        return rows.select(F.lit(kind).alias("kind"), start.alias("chunk_start"), end.alias("chunk_end"))

    chunks = (
        chunk(months, "month", F.col("m"), F.col("m") + F.expr("INTERVAL 45 DAY"))
        .union(chunk(months, "second", F.col("m"), F.col("m") + F.expr("INTERVAL 1 SECOND")))
        .union(chunk(months, "year", year, year + F.expr("INTERVAL 365 DAY")).distinct())
        .union(orders.agg(F.lit("all"), F.min(begin), F.max("o_orderdate")))
        .union(months.agg(F.lit("empty"), F.min("m"), F.min("m")))
    )
    return sweep_chunks(orders, chunks, "o_orderdate", ["o_orderkey"])


# Two landings of the events that share ten days.
FIRST_SQL = "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'"
SECOND_SQL = "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10'"


def landings(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    first = events.where(F.col("ts") < instant("2024-01-20"))
    second = events.where(F.col("ts") >= instant("2024-01-10"))
    return first, second


@query("q_u1", f"""SELECT event_id, event_type, ts FROM ({FIRST_SQL})
UNION ALL SELECT event_id, event_type, ts FROM ({SECOND_SQL})""")
def u1(spark, sf_dir):
    return concat(landings(spark, sf_dir)).select("event_id", "event_type", "ts")


@query("q_reconcile", f"""
WITH a AS ({FIRST_SQL}), b AS ({SECOND_SQL})
SELECT (SELECT COUNT(*) FROM a) AS left_count, (SELECT COUNT(*) FROM b) AS right_count,
  (SELECT COUNT(*) FROM (SELECT event_id FROM a INTERSECT SELECT event_id FROM b)) AS shared_keys,
  (SELECT COUNT(*) FROM (SELECT event_id FROM a EXCEPT SELECT event_id FROM b)) AS only_left,
  (SELECT COUNT(*) FROM (SELECT event_id FROM b EXCEPT SELECT event_id FROM a)) AS only_right""")
def reconcile_stores(spark, sf_dir):
    return reconcile_summary(*landings(spark, sf_dir), "event_id")


@query("q_u2", f"""
WITH a AS (SELECT user_id, COUNT(*) AS n FROM ({FIRST_SQL}) GROUP BY user_id),
     b AS (SELECT user_id, COUNT(*) AS n FROM ({SECOND_SQL}) GROUP BY user_id)
SELECT COALESCE(a.user_id, b.user_id) AS user_id, COALESCE(a.n, 0) AS left_rows,
  COALESCE(b.n, 0) AS right_rows
FROM a FULL JOIN b ON a.user_id = b.user_id WHERE COALESCE(a.n, 0) <> COALESCE(b.n, 0)""")
def u2(spark, sf_dir):
    return reconcile(*landings(spark, sf_dir), "user_id")


@query("q_u3", f"SELECT event_id FROM ({FIRST_SQL}) INTERSECT SELECT event_id FROM ({SECOND_SQL})")
def u3(spark, sf_dir):
    return overlap(*landings(spark, sf_dir), "event_id")
