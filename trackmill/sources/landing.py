"""Landed JSON: search pages, issue documents, dimensions and users.

Nothing is inferred: readers carry a schema, and what does not fit goes to quarantine.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trackmill.functions.instants import parse_instant
from trackmill.functions.projections import computed_once, custom_fields, labels
from trackmill.functions.text import any_column_contains
from trackmill.schemas import DIMENSIONS, ISSUE_DOCUMENT, PAGE

_CORRUPT = "_corrupt"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Search pages, one JSON document per line, or per file when ``multi_line``."""
    schema = StructType([*PAGE.fields, StructField(_CORRUPT, StringType())])
    return (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("multiLine", multi_line)
        .json(path)
    )


def page_issues(pages: DataFrame) -> DataFrame:
    """Issue documents of the pages as ``raw_json``, with where each stood."""
    return pages.select(
        F.col("startAt").alias("start_at"), F.posexplode("issues").alias("pos", "raw_json")
    )


def bad_pages(pages: DataFrame) -> DataFrame:
    """Pages that did not parse or lack a required part."""
    lacks = [F.col(field.name).isNull() for field in PAGE.fields if not field.nullable]
    broken = F.col(_CORRUPT).isNotNull()
    for lack in lacks:
        broken = broken | lack
    return pages.where(broken)


def read_issue_documents(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Issue documents as ``raw_json``; compressed files read by their extension.

    ``lines`` is one document per line and splits over tasks; ``array_lines`` is one array
    of documents per line and splits as well.  ``array`` is one JSON array per file, which
    a single task has to read whole: land large arrays as lines.  A damaged array is one
    document, its text, which then fails to parse and ends in the quarantine.  A missing
    path gives no rows.
    """
    if layout not in ("lines", "array", "array_lines"):
        raise ValueError("layout is lines, array_lines or array")
    try:
        text = spark.read.text(path, wholetext=layout == "array")
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], "raw_json string")
    if layout != "lines":
        listed = F.coalesce(F.from_json("value", "array<string>"), F.array("value"))
        return text.where(F.trim("value") != "").select(F.explode(listed).alias("raw_json"))
    return text.select(F.col("value").alias("raw_json")).where(F.trim("raw_json") != "")


def read_dimension(spark: SparkSession, path: str, kind: str, multi_line: bool = True) -> DataFrame:
    """One of the dimension lists; a landed file is a JSON array of records.

    What does not parse is left to :func:`dimension_quarantine`."""
    landed = _dimension(spark, path, kind, multi_line)
    # Spark wants another column beside the corrupt one; a corrupt record has no first member.
    first = F.col(DIMENSIONS[kind].fields[0].name)
    return landed.where(F.col(_CORRUPT).isNull() | (first == F.col(_CORRUPT))).drop(_CORRUPT)


def _dimension(spark: SparkSession, path: str, kind: str, multi_line: bool) -> DataFrame:
    schema = StructType([*DIMENSIONS[kind].fields, StructField(_CORRUPT, StringType())])
    try:
        reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT)
        return reader.option("multiLine", multi_line).json(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], schema)


def dimension_quarantine(spark: SparkSession, path: str, kind: str, multi_line: bool = True) -> DataFrame:
    """Files or lines of a dimension list that do not parse, as ``raw_json``, and records
    that lack a required member, with the ``reason``."""
    landed = _dimension(spark, path, kind, multi_line)
    lacks = F.coalesce(*[
        F.when(F.col(field.name).isNull(), f"missing {field.name}") for field in DIMENSIONS[kind].fields if not field.nullable
    ])
    broken = F.when(F.col(_CORRUPT).isNotNull(), "malformed record").otherwise(lacks)
    record = F.to_json(F.struct(*[F.col(field.name) for field in DIMENSIONS[kind].fields]))
    return landed.select(F.coalesce(F.col(_CORRUPT), record).alias("raw_json"), broken.alias("reason")).where(
        F.col("reason").isNotNull()
    )


def search_users(users: DataFrame, term: str,
                 columns: tuple[str, ...] = ("accountId", "displayName", "emailAddress")) -> DataFrame:
    """Users whose name, display name or address holds the term."""
    return users.where(any_column_contains([F.col(name) for name in columns], term))


def _absent(struct: StructType, at: Column, prefix: str = "") -> Column:
    """Path of the first required member that is null; members of an optional struct are
    required only where the struct is there."""
    found = []
    for field in struct.fields:
        path, member = f"{prefix}{field.name}", at[field.name]
        if not field.nullable:
            found.append(F.when(member.isNull(), path))
        if isinstance(field.dataType, StructType):
            found.append(F.when(member.isNotNull(), _absent(field.dataType, member, f"{path}.")))
    return F.coalesce(*found, F.lit(None).cast("string"))


def _timed(doc: Column) -> Column:
    times = [parse_instant(doc["fields"][name]).alias(f"_{name}") for name in ("created", "updated")]
    return F.struct(doc.alias("_doc"), *times)


def _judged(at: Column) -> Column:
    """A parsed document with its times and why it cannot be used; null when it can."""
    doc = at["_doc"]
    malformed = [
        F.when(doc["fields"][name].isNotNull() & at[f"_{name}"].isNull(), f"fields.{name}")
        for name in ("created", "updated")
    ]
    reason = (
        F.when(doc[_CORRUPT].isNotNull() | doc.isNull(), "malformed document")
        .otherwise(F.concat(F.lit("missing or malformed "), F.coalesce(_absent(ISSUE_DOCUMENT, doc), *malformed)))
    )
    return F.struct(*[at[name].alias(name) for name in ("_doc", "_created", "_updated")], reason.alias("reason"))


def _parsed(documents: DataFrame) -> DataFrame:
    with_corrupt = StructType([*ISSUE_DOCUMENT.fields, StructField(_CORRUPT, StringType())])
    doc = F.from_json("raw_json", with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT})
    # Once per row, as in computed_once.  The tests are so many that a method generated for them is too
    # long for the JVM to compile and crawls; functions of arrays are no part of such a method.
    return documents.select("raw_json", F.inline(F.transform(F.transform(F.array(doc), _timed), _judged)))


def judge(documents: DataFrame) -> DataFrame:
    """All documents, typed where they parse, with the reason of those that do not: one parse
    for :func:`rehydrate` and :func:`issue_quarantine` together."""
    return _parsed(documents).select("raw_json", F.col("_doc").dropFields(_CORRUPT).alias("issue"), "reason")


def rehydrate(documents: DataFrame) -> DataFrame:
    """Typed issue documents; the ones that do not parse are left out."""
    valid = _parsed(documents).where(F.col("reason").isNull())
    return valid.select("raw_json", F.col("_doc").dropFields(_CORRUPT).alias("issue"))


def issue_quarantine(documents: DataFrame) -> DataFrame:
    """Documents that do not parse, with the reason."""
    return _parsed(documents).where(F.col("reason").isNotNull()).select("raw_json", "reason")


def flatten_issues(documents: DataFrame) -> DataFrame:
    """Valid issue documents as rows of the issues table.

    Text descriptions are stored decoded, rich-text ones as JSON; both are whole in
    ``raw_json``, as are custom fields and the change log.
    """
    valid = _parsed(documents).where(F.col("reason").isNull())
    fields = "_doc.fields"
    return valid.select(
        F.col("_doc.id").alias("id"),
        F.col("_doc.key").alias("issue_key"),
        F.col(f"{fields}.summary").alias("summary"),
        F.col(f"{fields}.description").alias("description"),
        F.col(f"{fields}.status.name").alias("status_name"),
        F.col(f"{fields}.priority.name").alias("priority_name"),
        F.col(f"{fields}.issuetype.name").alias("issue_type_name"),
        F.col(f"{fields}.project.key").alias("project_key"),
        F.col(f"{fields}.project.name").alias("project_name"),
        F.col(f"{fields}.reporter.displayName").alias("reporter_display_name"),
        F.col(f"{fields}.assignee.displayName").alias("assignee_display_name"),
        F.col("_created").alias("created"),
        F.col("_updated").alias("updated"),
        parse_instant(F.col(f"{fields}.resolutiondate")).alias("resolution_date"),
        F.from_json(f"{fields}.labels", "array<string>").alias("labels"),
        "raw_json",
    )


def with_custom_fields(issues: DataFrame) -> DataFrame:
    """Issues with ``custom_fields`` and ``labels`` read out of ``raw_json``."""
    extra = custom_fields(F.get_json_object("raw_json", "$.fields"))
    return computed_once(issues, custom_fields=extra).withColumn("labels", labels(F.col("custom_fields")))


def changelogs(issues: DataFrame) -> DataFrame:
    """Issues that carry a change log, in the shape the change-log parser takes."""
    found = issues.select(
        F.col("id").alias("issue_id"), "issue_key",
        F.get_json_object("raw_json", "$.changelog").alias("changelog"),
    )
    return found.where(F.col("changelog").isNotNull())
