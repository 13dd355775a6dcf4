"""Nested change logs to flat history rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.functions.instants import Instant, instant, parse_instant
from trackmill.functions.projections import computed_once
from trackmill.functions.text import string_or_null

_CORRUPT = "_corrupt"
_ITEM = ("field", "fieldId", "from", "to", "fromString", "toString")
# One typed parse reads a log whose members have the types they should have.
_TYPED = f"""
    histories array<struct<
        id string, created string, author struct<accountId string, displayName string, emailAddress string>,
        items array<struct<{', '.join(f'`{name}` string' for name in _ITEM)}>>>>,
    {_CORRUPT} string
"""
# A text member with a value that is neither text nor null: the typed parse would take it for text.
# Few quotes are followed by such a value, so the name before the quote is looked at last.
_NOT_TEXT = (
    r'"(?=\s*+:\s*+[^"n\s])'
    r'(?<="(?:id|created|accountId|displayName|emailAddress|field|fieldId|from|to|fromString|toString)")'
)
# A member name that is spelt with an escape.
_ESCAPE, _ESCAPED = r"\u", r'"[^"]*\\u[^"]*"\s*:'
# Such logs are read with members as VARIANT, so that text can be told from other types,
# and entry by entry, so that a malformed one spoils no other.
_HISTORIES = "histories array<string>"
_LOOSE = f"""
    id variant, created variant, author variant,
    items array<struct<{', '.join(f'`{name}` variant' for name in _ITEM)}>>
"""

HISTORY_COLUMNS = (
    "issue_id", "issue_key", "change_id", "change_timestamp", "author_account_id",
    "author_display_name", "author_email", "field_name", "field_id", "from_value", "to_value",
    "from_display_value", "to_display_value", "history_pos", "item_pos",
)
MODES = ("quarantine", "strict", "issue")


def _entry(change_id: Column, created: Column, has_author: Column, author: list[Column], items: Column) -> Column:
    account, name, email = author
    return F.struct(
        change_id.alias("change_id"), created.alias("created"), has_author.alias("has_author"),
        account.alias("author_account_id"), name.alias("author_display_name"), email.alias("author_email"),
        items.alias("items"),
    )


def _typed_entry(entry: Column) -> Column:
    author = entry["author"]
    members = [author[name] for name in ("accountId", "displayName", "emailAddress")]
    return _entry(entry["id"], entry["created"], author.isNotNull(), members, entry["items"])


def _loose_entry(entry: Column) -> Column:
    author = entry["author"]
    members = [
        string_or_null(F.try_variant_get(author, f"$.{name}", "variant"))
        for name in ("accountId", "displayName", "emailAddress")
    ]
    items = F.transform(
        entry["items"], lambda item: F.struct(*[string_or_null(item[name]).alias(name) for name in _ITEM])
    )
    there = author.isNotNull() & (F.schema_of_variant(author) != "VOID")
    return _entry(
        string_or_null(entry["id"]), string_or_null(entry["created"]), F.coalesce(there, F.lit(False)), members, items
    )


def _loose(log: Column) -> Column:
    """Entries of a doubtful log; each text is parsed once, as the one element of an array."""
    return F.transform(
        F.from_json(log, _HISTORIES)["histories"],
        lambda text: F.transform(F.array(F.from_json(text, _LOOSE)), _loose_entry)[0],
    )


def _violation(entry: Column, time: Column) -> Column:
    """Why an entry cannot be used; null when it can."""
    broken = entry["has_author"] & (entry["author_account_id"].isNull() | entry["author_display_name"].isNull())
    return (
        F.when(entry["change_id"].isNull(), "no-change-id")
        .when(entry["created"].isNull(), "no-time")
        .when(time.isNull(), "bad-time")
        .when(broken, "author-incomplete")
        .when(entry["items"].isNull(), "no-items")
        .when(~F.forall(entry["items"], lambda item: item["field"].isNotNull()), "field-unnamed")
    )


def _judged(entries: Column) -> Column:
    timed = F.transform(
        entries, lambda entry: F.struct(entry.alias("entry"), parse_instant(entry["created"]).alias("change_timestamp"))
    )
    return F.transform(timed, lambda at: F.struct(
        at["entry"].alias("entry"), at["change_timestamp"].alias("change_timestamp"),
        _violation(at["entry"], at["change_timestamp"]).alias("violation"),
    ))


def _logs(issues: DataFrame, changelog: str) -> DataFrame:
    """Every log with its judged entries, or with none where it has no list of them."""
    log = F.col(changelog)
    typed = F.from_json(log, _TYPED, {"columnNameOfCorruptRecord": _CORRUPT})
    logs = computed_once(issues.select("issue_id", "issue_key", changelog), _doc=typed)
    escaped = log.contains(_ESCAPE) & log.rlike(_ESCAPED)
    doubtful = F.col("_doc").isNull() | F.col(f"_doc.{_CORRUPT}").isNotNull() | escaped | log.rlike(_NOT_TEXT)
    entries = F.when(doubtful, _loose(log)).otherwise(F.transform(F.col("_doc.histories"), _typed_entry))
    read = computed_once(logs, _entries=entries)
    return computed_once(read, _judged=_judged(F.col("_entries"))).select("issue_id", "issue_key", "_judged")


def _entries(logs: DataFrame) -> DataFrame:
    judged = logs.select("issue_id", "issue_key", F.posexplode("_judged").alias("history_pos", "_j"))
    return judged.select("issue_id", "issue_key", "history_pos", "_j.*").select("*", "entry.*").drop("entry")


def parse_changelog(
    issues: DataFrame, changelog: str = "changelog", mode: str = "quarantine"
) -> DataFrame:
    """One history row per changed field of every valid entry.

    ``issues`` has ``issue_id``, ``issue_key`` and the change log as JSON text.  An invalid
    entry is left to :func:`changelog_quarantine`; in mode ``issue`` it takes all entries of
    its log with it, and in mode ``strict`` it fails the job.  An entry without items gives
    no rows.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    logs = _logs(issues, changelog)
    if mode == "strict":
        # The log itself raises: a separate filter could run after Spark has already
        # dropped the entries that give no rows.
        first = F.get(F.filter("_judged", lambda j: j["violation"].isNotNull()), F.lit(0))["violation"]
        reason = F.when(F.col("_judged").isNull(), "no-histories").otherwise(first)
        complaint = F.raise_error(F.concat_ws(": ", "issue_key", reason))
        logs = logs.withColumn("_judged", F.when(reason.isNotNull(), complaint).otherwise(F.col("_judged")))
    elif mode == "issue":
        logs = logs.where(F.forall("_judged", lambda j: j["violation"].isNull()))
    valid = _entries(logs).where(F.col("violation").isNull())
    items = valid.select("*", F.posexplode("items").alias("item_pos", "_item"))
    named = zip(
        _ITEM, ("field_name", "field_id", "from_value", "to_value", "from_display_value", "to_display_value"), strict=True
    )
    return items.select(
        "*", *[F.col("_item").getField(member).alias(name) for member, name in named]
    ).select(*HISTORY_COLUMNS)


def changelog_quarantine(issues: DataFrame, changelog: str = "changelog") -> DataFrame:
    """Entries that break a rule, with the rule; a log without a list of entries is one row
    without a position."""
    logs = _logs(issues, changelog)
    columns = ("issue_id", "issue_key", "history_pos", "change_id", "violation")
    broken = logs.select("issue_id", "issue_key", F.posexplode_outer("_judged").alias("history_pos", "_j"), "_judged")
    none = F.when(F.col("_judged").isNull(), "no-histories")
    told = broken.select(
        "issue_id", "issue_key", "history_pos", F.col("_j.entry.change_id").alias("change_id"),
        F.coalesce(none, F.col("_j.violation")).alias("violation"),
    )
    return told.where(F.col("violation").isNotNull()).select(*columns)


def as_history(parsed: DataFrame, created_at: Instant) -> DataFrame:
    """Parsed rows in the layout of the history table.

    ``history_id`` is a label computed from the row, so a repeated run gives it again.
    """
    label = F.xxhash64("issue_id", "change_id", "history_pos", "item_pos")
    return parsed.select(
        label.alias("history_id"),
        *[name for name in HISTORY_COLUMNS if name != "history_pos"],
        instant(created_at).alias("created_at"),
    )
