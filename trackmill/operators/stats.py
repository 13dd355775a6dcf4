"""Counts, distributions, rates and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.functions.changes import CHANGE_TYPES, change_label, change_type
from trackmill.functions.instants import Instant, as_utc, instant, run_seconds
from trackmill.functions.projections import percent
from trackmill.functions.text import or_default
from trackmill.operators.filters import MONTH, DateRange, IssueFilter, months_between

# --- fixed values: display defaults and JSON type names ---
UNASSIGNED = "unassigned"
UNKNOWN = "unknown"
JSON_TYPES = {
    "STRING": "String",
    "BOOLEAN": "Boolean",
    "VOID": "null",
}
# --- end of fixed values ---


STAT_PARTS = ["project_key", "status_name", "issue_type_name"]


def total(issues: DataFrame) -> DataFrame:
    return issues.agg(F.count("*").alias("total_issues"))


def count_by(df: DataFrame, column: str | Column, name: str = "n") -> DataFrame:
    """Rows per value, null as a group of its own."""
    return df.groupBy(column).agg(F.count("*").alias(name))


def count_by_project(issues: DataFrame) -> DataFrame:
    """Issues per project; issues without a project are left out."""
    return count_by(issues.where(F.col("project_key").isNotNull()), "project_key")


def storage_stats(issues: DataFrame) -> DataFrame:
    """Total and counts by project, status and type as rows ``(metric, key, n)``.

    The issues are read once and reduced to their few combinations; the grouping sets
    expand those and not the issues.
    """
    combinations = issues.groupBy(*STAT_PARTS).agg(F.count("*").alias("_n"))
    rows = _by_metric(combinations)
    return rows.where((F.col("n") > 0) | (F.col("metric") == "total"))


def _by_metric(combinations: DataFrame) -> DataFrame:
    """Rows ``(metric, key, n)`` of combinations of project, status and type with their ``_n``."""
    # An empty table still has a total.
    nothing = combinations.sparkSession.range(1).select(
        *[F.lit(None).cast("string").alias(part) for part in STAT_PARTS], F.lit(0).cast("long").alias("_n")
    )
    combinations = combinations.unionByName(nothing)
    sets = [[], *[[F.col(part)] for part in STAT_PARTS]]
    grouped = combinations.groupingSets(sets, *[F.col(part) for part in STAT_PARTS]).agg(
        F.sum("_n").alias("n"), *[F.grouping(part).alias(f"_{part}") for part in STAT_PARTS]
    )
    metric = (
        F.when(F.col("_project_key") == 0, "project")
        .when(F.col("_status_name") == 0, "status")
        .when(F.col("_issue_type_name") == 0, "type")
        .otherwise("total")
    )
    key = F.coalesce("project_key", "status_name", "issue_type_name")
    rows = grouped.select(metric.alias("metric"), key.alias("key"), "n")
    return rows.where((F.col("metric") != "project") | F.col("key").isNotNull())


def stats_delta(changes: DataFrame) -> DataFrame:
    """What a change feed (``upsert.change_feed``) does to the statistics: signed rows
    ``(metric, key, n)``.  A row that was counts -1, a row that is now +1; the base is not read."""
    sides = [
        changes.where(F.col(side).isNotNull()).select(*[F.col(f"{side}.{part}") for part in STAT_PARTS], F.lit(sign).alias("_one"))
        for side, sign in (("before", -1), ("after", 1))
    ]
    combinations = sides[0].unionByName(sides[1]).groupBy(*STAT_PARTS).agg(F.sum("_one").cast("long").alias("_n"))
    return _by_metric(combinations.where(F.col("_n") != 0)).where(F.col("n") != 0)


def fold_stats(snapshot: DataFrame, delta: DataFrame) -> DataFrame:
    """The stored statistics with the changes taken in.  What no issue has any more is no row, but the
    total stays; a count below nothing says that a change was taken in twice, and fails."""
    both = snapshot.unionByName(delta).groupBy("metric", "key").agg(F.sum("n").alias("n"))
    short = F.raise_error(F.concat_ws(" ", F.lit("changes take more than there was of"), "metric", "key"))
    checked = F.when(F.col("n") < 0, short.cast("long")).otherwise(F.col("n"))
    return both.where((F.col("n") != 0) | (F.col("metric") == "total")).select("metric", "key", checked.alias("n"))


def count_matching(issues: DataFrame, spec: IssueFilter) -> DataFrame:
    """How many issues match; limit and offset of the filter play no part."""
    return spec.apply(issues).agg(F.count("*").alias("n"))


def history_stats(history: DataFrame, approximate: bool = False) -> DataFrame:
    """Changes, issues, authors and the span of change times.

    History is read once and reduced to its pairs of issue and author; each pair then says its
    issue and its author, which are reduced to one row each and counted.
    ``approximate`` counts them with a sketch instead, in one pass that shuffles no keys.
    """
    if approximate:
        return history.agg(
            F.count("*").alias("total_changes"),
            F.approx_count_distinct("issue_key").alias("unique_issues"),
            F.approx_count_distinct("author_account_id").alias("unique_authors"),
            F.min("change_timestamp").alias("oldest_change"),
            F.max("change_timestamp").alias("newest_change"),
        )
    pairs = history.groupBy("issue_key", "author_account_id").agg(
        F.count("*").alias("_n"), F.min("change_timestamp").alias("_first"), F.max("change_timestamp").alias("_last")
    )
    # Each pair says its issue and its author; a key's first row, whichever it is, stands for it.
    keyed = pairs.select(
        "_n", "_first", "_last",
        F.explode(F.array(
            F.struct(F.lit("issue").alias("kind"), F.col("issue_key").alias("key"), F.lit(1).alias("counts")),
            F.struct(F.lit("author").alias("kind"), F.col("author_account_id").alias("key"), F.lit(0).alias("counts")),
        )).alias("_of"),
    )
    found = keyed.groupBy("_of.kind", "_of.key").agg(
        F.sum(F.col("_n") * F.col("_of.counts")).alias("_n"), F.min("_first").alias("_first"), F.max("_last").alias("_last")
    )
    return found.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_changes"),
        F.count(F.when(F.col("kind") == "issue", F.col("key"))).alias("unique_issues"),
        F.count(F.when(F.col("kind") == "author", F.col("key"))).alias("unique_authors"),
        F.min("_first").alias("oldest_change"),
        F.max("_last").alias("newest_change"),
    )


def changes_per_field(history: DataFrame) -> DataFrame:
    return count_by(history, "field_name")


def with_change_group(history: DataFrame) -> DataFrame:
    """History rows under the label of their change type.

    Groups stay rows: written ``partitionBy('change_group')`` each is one folder.
    """
    return history.withColumn("change_group", change_label(change_type()))


def change_type_counts(history: DataFrame) -> DataFrame:
    return count_by(with_change_group(history), "change_group")


def change_type_map(history: DataFrame, by: str) -> DataFrame:
    """Per ``by`` a map from change type to count, over the fixed set of types."""
    kinds = history.select(by, change_type().alias("_kind"))
    entries = []
    for kind in CHANGE_TYPES:
        entries += [F.lit(kind), F.count_if(F.col("_kind") == kind)]
    return kinds.groupBy(by).agg(F.create_map(*entries).alias("changes"))


def author_field_counts(history: DataFrame, since: Instant) -> DataFrame:
    """Changes per author and field since an instant; stored history is read from its month on."""
    recent = history.where(F.col("change_timestamp") >= instant(since))
    if MONTH in history.columns:
        recent = recent.where(months_between(since))
    counted = recent.groupBy("author_display_name", "field_name").agg(F.count("*").alias("change_count"))
    return counted.orderBy(F.col("change_count").desc(), "author_display_name", "field_name")


def top_values(
    df: DataFrame, column: str, k: int = 5, default: str | None = None, name: str = "n"
) -> DataFrame:
    """The ``k`` most frequent values.  Nulls are skipped, or counted as ``default``."""
    value = F.col(column)
    rows = df.select(or_default(value, default).alias(column)) if default else df.where(value.isNotNull())
    return count_by(rows, column, name).orderBy(F.col(name).desc(), column).limit(k)


def distribution(issues: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Count of every present value of ``column`` within the groups ``by``."""
    present = issues.where(F.col(column).isNotNull())
    return present.groupBy(*by, column).agg(F.count("*").alias("n"))


def share_of_total(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Count and percent of all rows per present value, the largest ``k`` if given."""
    counted = count_by(df, column)
    everything = counted.agg(F.sum("n")).scalar()
    shares = counted.where(F.col(column).isNotNull()).withColumn(
        "percent", F.round(percent(F.col("n"), everything), 4)
    )
    if k is None:
        return shares
    return shares.orderBy(F.col("n").desc(), column).limit(k)


def creation_rate(issues: DataFrame, as_of: Instant, days: Sequence[int] = (7, 30)) -> DataFrame:
    """Issues created in the last days and their rate per day, all spans in one pass."""
    widest = DateRange(as_utc(as_of) - timedelta(days=max(days)), as_of)
    measures = []
    for span in days:
        created = F.count_if(DateRange.last_days(span, as_of).condition("created"))
        measures.append(created.alias(f"created_{span}d"))
        measures.append(F.round(created / F.lit(float(span)), 6).alias(f"rate_{span}d"))
    return issues.where(widest.condition("created")).agg(*measures)


def count_by_type(projects: DataFrame, column: str) -> DataFrame:
    """Rows per type, absent types under one name."""
    return count_by(projects, or_default(F.col(column), UNKNOWN).alias(column))


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with every column filled, missing values per column (null or empty), percent."""
    missing = {c: F.col(c).isNull() | (F.col(c).cast("string") == "") for c in columns}
    complete = F.lit(True)
    for gap in missing.values():
        complete = complete & ~gap
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(complete).alias("complete"),
        *[F.count_if(gap).alias(f"missing_{c}") for c, gap in missing.items()],
    ).withColumn("complete_percent", F.round(percent(F.col("complete"), F.col("rows")), 4))


def sync_stats(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Runs, successes, issues, mean duration and last times, per service if wanted."""
    done = F.when(F.col("is_success"), F.col("end_time"))
    done_order = F.when(F.col("is_success"), F.col("run_id"))
    return runs.groupBy(*by).agg(
        F.count("*").alias("total_syncs"),
        F.count_if("is_success").alias("successful_syncs"),
        F.coalesce(F.sum("synced_count"), F.lit(0)).alias("total_issues_synced"),
        F.coalesce(
            F.round(F.avg(run_seconds(F.col("start_time"), F.col("end_time"))), 6), F.lit(0.0)
        ).alias("average_duration_seconds"),
        F.max_by("end_time", "run_id").alias("last_sync_time"),
        F.max_by(done, done_order).alias("last_successful_sync_time"),
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def json_type(value: Column) -> Column:
    """JSON type name of a VARIANT value."""
    schema = F.schema_of_variant(value)
    kind = F.when(schema.startswith("OBJECT"), "Object").when(schema.startswith("ARRAY"), "Array")
    for name, label in JSON_TYPES.items():
        kind = kind.when(schema == name, label)
    return kind.otherwise("Number")


def field_profile(documents: DataFrame, json_column: str) -> DataFrame:
    """How often every key of the JSON objects holds which JSON type."""
    parsed = documents.select(F.try_parse_json(F.col(json_column)).alias("_doc"))
    entries = parsed.lateralJoin(
        documents.sparkSession.tvf.variant_explode(F.col("_doc").outer())
    )
    typed = entries.where(F.col("key").isNotNull()).select(
        F.col("key").alias("field"), json_type(F.col("value")).alias("json_type")
    )
    return typed.groupBy("field", "json_type").agg(F.count("*").alias("n"))


def in_span(history: DataFrame, span: DateRange) -> DataFrame:
    """Changes of a span; of stored history only its months are read."""
    inside = history.where(span.condition("change_timestamp"))
    return inside.where(months_between(span.start, span.end)) if MONTH in history.columns else inside


def _owned(history: DataFrame, issues: DataFrame, projects: Sequence[str] | None) -> DataFrame:
    """Changes with the project of their issue, of the listed projects or of all.  Every issue occurs
    once on that side, so an issue with very many changes is split by adaptive execution."""
    owners = issues.where(F.col("project_key").isNotNull())
    if projects is not None:
        owners = owners.where(F.col("project_key").isin(list(projects)))
    return history.join(owners.select(F.col("id").alias("issue_id"), "project_key"), "issue_id")


def project_history_stats(history: DataFrame, issues: DataFrame, span: DateRange,
                          projects: Sequence[str] | None = None) -> DataFrame:
    """Changes of a span per project and change type, and their first and last time."""
    owned = _owned(in_span(history, span), issues, projects)
    return with_change_group(owned).groupBy("project_key", "change_group").agg(
        F.count("*").alias("changes"), F.min("change_timestamp").alias("first_change"),
        F.max("change_timestamp").alias("last_change"),
    )


def project_activity(history: DataFrame, issues: DataFrame, span: DateRange,
                     projects: Sequence[str] | None = None) -> DataFrame:
    """Changes of a span per project, with how many of its issues have history and how many
    authors made it.

    Changes are reduced to (project, issue, author) first; a project with very many is then counted
    by issue and by author, each of which combines inside tasks.
    """
    triples = _owned(in_span(history, span), issues, projects).groupBy(
        "project_key", "issue_key", "author_account_id"
    ).agg(F.count("*").alias("_n"))
    keyed = triples.select("project_key", F.explode(F.array(
        F.struct(F.lit(True).alias("issue"), F.col("issue_key").alias("key"), F.col("_n").alias("n")),
        F.struct(F.lit(False).alias("issue"), F.col("author_account_id").alias("key"), F.lit(0).cast("long").alias("n")),
    )).alias("_of"))
    once = keyed.groupBy("project_key", "_of.issue", "_of.key").agg(F.sum("_of.n").alias("_n"))
    return once.groupBy("project_key").agg(
        F.sum("_n").alias("changes"), F.count(F.when(F.col("issue"), F.col("key"))).alias("issues_with_history"),
        F.count(F.when(~F.col("issue"), F.col("key"))).alias("authors"),
    )


def top_authors_of(history: DataFrame, issues: DataFrame, project_key: str | Sequence[str], k: int,
                   span: DateRange | None = None) -> DataFrame:
    """The ``k`` most active authors on the issues of one project, or of a list of them."""
    listed = [project_key] if isinstance(project_key, str) else list(project_key)
    own = issues.where(F.col("project_key").isin(listed)).select(F.col("id").alias("issue_id"))
    return top_authors(history.join(own, "issue_id", "left_semi").select(*history.columns), k, span)


def top_authors(history: DataFrame, k: int, span: DateRange | None = None,
                among: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The ``k`` most active authors with the issues they touched, over a span and among
    the rows whose columns hold one of the listed values."""
    if span is not None:
        history = in_span(history, span)
    for column, values in (among or {}).items():
        history = history.where(F.col(column).isin(list(values)))
    authored = history.where(F.col("author_account_id").isNotNull())
    counted = authored.groupBy("author_account_id").agg(
        F.count("*").alias("changes"), F.count_distinct("issue_key").alias("issues")
    )
    return counted.orderBy(F.col("changes").desc(), "author_account_id").limit(k)
