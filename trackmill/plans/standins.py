"""The benchmark tables seen as issues, change history, documents and runs.

Every view is a plain projection, join or aggregate of whole tables.  The ``*_SQL``
constants are the same views as common table expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed reference times instead of the clock: end of the orders and of the events.
ORDERS_AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"

HISTORY_TIES = ("issue_key", "change_id", "field_name")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- issues ------------------------------------------------------------------

FLAT_SQL = """
flat_issues AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey,
         o_orderstatus AS status_name,
         NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS priority_name,
         CASE WHEN o_totalprice >= 300000 THEN 'Epic'
              WHEN o_totalprice >= 100000 THEN 'Story' ELSE 'Task' END AS issue_type_name,
         o_orderdate AS created
  FROM orders)
"""


def flat_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues as far as ``orders`` alone describes them."""
    return _flat(table(spark, sf_dir, "orders"))


def _flat(orders: DataFrame, *more: str) -> DataFrame:
    price = F.col("o_totalprice")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        "o_custkey",
        F.col("o_orderstatus").alias("status_name"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority_name"),
        F.when(price >= 300000, "Epic").when(price >= 100000, "Story").otherwise("Task").alias("issue_type_name"),
        F.col("o_orderdate").alias("created"),
        *more,
    )


OWNED_SQL = FLAT_SQL + """,
owned_issues AS (
  SELECT id, c_mktsegment || '-' || id AS issue_key,
         'Order ' || id || ' placed by ' || c_name AS summary,
         status_name, priority_name, issue_type_name,
         NULLIF(c_mktsegment, 'HOUSEHOLD') AS project_key,
         c_name AS reporter_display_name,
         CASE WHEN c_acctbal >= 0 THEN c_name END AS assignee_display_name, created
  FROM flat_issues JOIN customer ON o_custkey = c_custkey)
"""


def owned_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues with project and people, from ``orders`` and ``customer``.

    One segment stands for issues without a project, a negative balance for unassigned.
    """
    return _owned(flat_issues(spark, sf_dir), table(spark, sf_dir, "customer"))


def _owned(flat: DataFrame, customers: DataFrame, *more: str) -> DataFrame:
    customers = customers.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_acctbal")
    return flat.join(customers, "o_custkey").select(
        "id",
        F.concat_ws("-", "c_mktsegment", "id").alias("issue_key"),
        F.concat(F.lit("Order "), "id", F.lit(" placed by "), "c_name").alias("summary"),
        "status_name", "priority_name", "issue_type_name",
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("project_key"),
        F.col("c_name").alias("reporter_display_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("assignee_display_name"),
        "created",
        *more,
    )


ISSUES_SQL = OWNED_SQL + """,
last_change AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS change_of, MAX(l_shipdate) AS changed
  FROM lineitem GROUP BY l_orderkey),
issues AS (
  SELECT i.*, GREATEST(created, COALESCE(changed, created)) AS updated,
         CASE WHEN status_name = 'F' THEN GREATEST(created, COALESCE(changed, created)) END
           AS resolution_date
  FROM owned_issues i LEFT JOIN last_change ON id = change_of)
"""


def last_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("changed")).select(
        F.col("l_orderkey").cast("string").alias("id"), "changed"
    )


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues with their last change from ``lineitem``."""
    changed = owned_issues(spark, sf_dir).join(last_changes(spark, sf_dir), "id", "left")
    updated = F.greatest("created", F.coalesce("changed", "created"))
    with_update = changed.withColumn("updated", updated).drop("changed")
    return with_update.withColumn(
        "resolution_date", F.when(F.col("status_name") == "F", F.col("updated"))
    )


# --- change history ----------------------------------------------------------

HISTORY_SQL = """
history AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS issue_id, 'ORD-' || l_orderkey AS issue_key,
         l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
           || CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS change_id,
         l_shipdate AS change_timestamp,
         'S' || l_suppkey AS author_account_id,
         CASE WHEN l_discount > 0 THEN 'Supplier ' || l_suppkey END AS author_display_name,
         CASE WHEN l_returnflag = 'A' THEN 'status' WHEN l_returnflag = 'R' THEN 'priority'
              WHEN l_linestatus = 'F' THEN 'assignee' ELSE 'Sprint' END AS field_name,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' AND l_tax > 0
              THEN 'customfield_10010' END AS field_id,
         CASE WHEN l_tax > 0 THEN l_returnflag END AS from_display_value,
         l_linestatus AS to_display_value
  FROM lineitem)
"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as one change of its order."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    field = (
        F.when(flag == "A", "status").when(flag == "R", "priority")
        .when(status == "F", "assignee").otherwise("Sprint")
    )
    custom = (flag == "N") & (status == "O") & (F.col("l_tax") > 0)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("issue_id"),
        F.concat(F.lit("ORD-"), "l_orderkey").alias("issue_key"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")],
                    cents.cast("string")).alias("change_id"),
        F.col("l_shipdate").alias("change_timestamp"),
        F.concat(F.lit("S"), "l_suppkey").alias("author_account_id"),
        F.when(F.col("l_discount") > 0, F.concat(F.lit("Supplier "), "l_suppkey")).alias("author_display_name"),
        F.lit(None).cast("string").alias("author_email"),
        field.alias("field_name"),
        F.when(custom, "customfield_10010").alias("field_id"),
        F.when(F.col("l_tax") > 0, flag).alias("from_display_value"),
        status.alias("to_display_value"),
    )


# --- text --------------------------------------------------------------------


def part_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as issues whose summary is the part name."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("summary"),
        F.col("p_brand").alias("project_key"), F.col("p_type").alias("issue_type_name"),
    )


def document_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as issues whose description is the text."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("description"),
        F.col("lang").alias("issue_type_name"), F.col("source").alias("project_key"),
    )


LABELLED_SQL = """
labelled AS (
  SELECT d.doc_id AS id, lang, source,
         quality, toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, where they have any."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        F.col("doc_id").alias("id"), "lang", "source", "quality", "toxic"
    )


# --- synchronisation runs ----------------------------------------------------

RUNS_SQL = """
runs AS (
  SELECT 'user-' || user_id AS service, CAST(EXTRACT(day FROM ts) AS BIGINT) AS run_id,
         MIN(ts) AS start_time, MAX(ts) AS end_time, COUNT(*) AS synced_count,
         COUNT(*) FILTER (event_type = 'signup') AS new_count,
         COUNT(*) FILTER (event_type = 'purchase') AS updated_count,
         COUNT(*) FILTER (event_type = 'error') AS error_count,
         COUNT(*) FILTER (event_type = 'error') = 0 AS is_success
  FROM events GROUP BY user_id, EXTRACT(day FROM ts))
"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a user on one day as one run of that user's service."""
    kind = F.col("event_type")
    grouped = table(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("user-"), "user_id").alias("service"),
        F.dayofmonth("ts").cast("long").alias("run_id"),
    )
    return grouped.agg(
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.count("*").alias("synced_count"),
        F.count_if(kind == "signup").alias("new_count"),
        F.count_if(kind == "purchase").alias("updated_count"),
        F.count_if(kind == "error").alias("error_count"),
        (F.count_if(kind == "error") == 0).alias("is_success"),
    )


# --- landed documents --------------------------------------------------------


def _iso(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000"))


def _ref(kind: str, name: Column) -> list[Column]:
    """The three members every referenced record has."""
    address = F.concat(F.lit(f"https://tracker.example/{kind}/"), name)
    return [name.alias("id"), name.alias("name"), address.alias("self")]


def _user(name: Column) -> Column:
    address = F.concat(F.lit("https://tracker.example/user/"), name)
    return F.struct(name.alias("accountId"), name.alias("displayName"), address.alias("self"))


def issue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every issue as the JSON a tracker would land."""
    return issue_rows(spark, sf_dir).select(issue_document().alias("raw_json"))


def issue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`issue_document` makes documents of, a fraction of their size: what has to move
    moves as rows.  Orders meet their lines before their customers, by number and without names."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, sf_dir, "orders").join(lines.agg(F.max("l_shipdate").alias("changed")), "o_orderkey", "left")
    rows = _owned(_flat(orders, "changed"), table(spark, sf_dir, "customer"), "changed")
    updated = F.when(F.col("changed").isNotNull(), F.greatest("created", "changed"))
    return rows.withColumn("updated", updated).drop("changed")


def issue_document() -> Column:
    """The JSON of one of :func:`issue_rows`.

    An issue without any change has no ``updated`` and so does not parse.  Descriptions
    of open issues are rich text, the others plain.
    """
    name = F.col("reporter_display_name")
    rich = F.to_variant_object(F.struct(F.lit("doc").alias("type"), F.col("summary").alias("text")))
    plain = F.concat(F.lit("About "), "summary").cast("variant")
    category = F.struct(
        F.lit(2).alias("id"), F.lit("new").alias("key"), F.lit("To Do").alias("name"),
        F.lit("blue-gray").alias("colorName"),
    )
    fields = F.struct(
        "summary",
        F.when(F.col("status_name") == "O", rich).otherwise(plain).alias("description"),
        F.struct(*_ref("issuetype", F.col("issue_type_name"))).alias("issuetype"),
        F.when(F.col("priority_name").isNotNull(), F.struct(*_ref("priority", F.col("priority_name")))).alias("priority"),
        F.struct(*_ref("status", F.col("status_name")), category.alias("statusCategory")).alias("status"),
        F.when(F.col("assignee_display_name").isNotNull(), _user(name)).alias("assignee"),
        _user(name).alias("reporter"),
        _iso(F.col("created")).alias("created"),
        _iso(F.col("updated")).alias("updated"),
        F.when(F.col("status_name") == "F", _iso(F.col("updated"))).alias("resolutiondate"),
        F.when(
            F.col("project_key").isNotNull(),
            F.struct(*_ref("project", F.col("project_key")), F.col("project_key").alias("key")),
        ).alias("project"),
        F.array(F.lower("status_name"), F.lower("issue_type_name")).alias("labels"),
        F.length("summary").alias("customfield_10001"),
        F.struct(F.col("issue_type_name").alias("value")).alias("customfield_10002"),
    )
    address = F.concat(F.lit("https://tracker.example/issue/"), "id")
    document = F.struct("id", F.col("issue_key").alias("key"), address.alias("self"), fields.alias("fields"))
    return F.to_json(document)


def _paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a partition by their page, whose numbers rise: one row for each page."""
    page, held = None, []

    def gathered() -> pa.RecordBatch:
        there = [text for texts in held for text in texts.to_pylist() if text is not None]
        return pa.RecordBatch.from_pydict({
            "_page": pa.array([page], pa.int64()), "_count": pa.array([len(there)], pa.int32()),
            "_issues": pa.array([",".join(there)], pa.string()),
        })

    for batch in batches:
        numbers, texts = batch.column("_page").to_numpy(), batch.column("raw_json")
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start == end:
                continue
            if held and numbers[start] != page:
                yield gathered()
                held = []
            page = int(numbers[start])
            held.append(texts.slice(start, end - start))
    if held:
        yield gathered()


def result_pages(documents: DataFrame, size: int) -> DataFrame:
    """Documents gathered into search pages, ``size`` to a page.

    Serial numbers inside a partition are dense, so a page never holds more than that.  The
    documents of a page follow one another in a task, which gathers them where they are made:
    their text is neither kept nor sent anywhere.
    """
    serial = F.monotonically_increasing_id()
    numbered = documents.select("raw_json", F.floor(serial / F.lit(size)).alias("_page"))
    pages = numbered.mapInArrow(_paged, "_page bigint, _count int, _issues string")
    return pages.select(F.concat(
        F.lit('{"startAt":'), (F.col("_page") * size).cast("string"),
        F.lit(f',"maxResults":{size},"total":'), F.col("_count").cast("string"),
        F.lit(',"issues":['), "_issues", F.lit("]}"),
    ).alias("value"))


def changelog_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as one landed page of its order's change log.

    A page has one entry with up to three changed fields.  A line without discount has no
    author, one of quantity 50 an author without a name, one without tax and discount no
    time: the last two are invalid.
    """
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    supplier = F.concat(F.lit("S"), "l_suppkey")
    name = F.when(F.col("l_quantity") != 50, F.concat(F.lit("Supplier "), "l_suppkey"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").cast("string")

    def item(field: str, before: Column, after: Column, field_id: str | None = None) -> Column:
        return F.struct(
            F.lit(field).alias("field"), F.lit(field_id).cast("string").alias("fieldId"),
            before.alias("from"), after.alias("to"), before.alias("fromString"),
            after.alias("toString"),
        )

    nothing = F.lit(None).cast("string")
    items = F.array(
        item("status", nothing, status),
        item("priority", F.when(F.col("l_tax") > 0, flag), flag),
        item("Quantity", nothing, F.col("l_quantity").cast("long").cast("string"), "customfield_10020"),
    )
    entry = F.struct(
        F.concat_ws("-", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), cents).alias("id"),
        F.when((F.col("l_tax") > 0) | (F.col("l_discount") > 0), _iso(F.col("l_shipdate"))).alias("created"),
        F.when(F.col("l_discount") > 0, F.struct(supplier.alias("accountId"), name.alias("displayName"))).alias("author"),
        items.alias("items"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    return lines.select(
        F.col("l_orderkey").cast("string").alias("issue_id"),
        F.concat(F.lit("ORD-"), "l_orderkey").alias("issue_key"),
        F.to_json(F.struct(F.array(entry).alias("histories"))).alias("changelog"),
    )


CHANGELOG_SQL = """
entries AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS issue_id, 'ORD-' || l_orderkey AS issue_key,
         l_linenumber || '-' || l_partkey || '-' || CAST(ROUND(l_extendedprice * 100) AS BIGINT)
           AS change_id,
         l_shipdate AS change_timestamp,
         CASE WHEN l_discount > 0 THEN 'S' || l_suppkey END AS author_account_id,
         CASE WHEN l_discount > 0 THEN 'Supplier ' || l_suppkey END AS author_display_name,
         l_linestatus, l_returnflag, l_tax, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
         CASE WHEN l_tax = 0 AND l_discount = 0 THEN 'no-time'
              WHEN l_discount > 0 AND l_quantity = 50
              THEN 'author-incomplete' END AS violation
  FROM lineitem),
changes AS (
  SELECT issue_id, issue_key, change_id, change_timestamp, author_account_id,
         author_display_name, 0 AS item_pos, 'status' AS field_name,
         CAST(NULL AS VARCHAR) AS field_id, CAST(NULL AS VARCHAR) AS from_value,
         l_linestatus AS to_value
  FROM entries WHERE violation IS NULL
  UNION ALL
  SELECT issue_id, issue_key, change_id, change_timestamp, author_account_id,
         author_display_name, 1, 'priority', NULL,
         CASE WHEN l_tax > 0 THEN l_returnflag END, l_returnflag
  FROM entries WHERE violation IS NULL
  UNION ALL
  SELECT issue_id, issue_key, change_id, change_timestamp, author_account_id,
         author_display_name, 2, 'Quantity', 'customfield_10020', NULL, quantity
  FROM entries WHERE violation IS NULL)
"""
