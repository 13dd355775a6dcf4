"""Schemas of landed documents and of the tables built from them.

A field marked not-null is required: readers load everything as nullable and use the
mark to tell valid documents from those that go to quarantine.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _text(name: str, required: bool = False) -> StructField:
    return StructField(name, StringType(), not required)


def _flag(name: str) -> StructField:
    return StructField(name, BooleanType(), True)


def _number(name: str, required: bool = False) -> StructField:
    return StructField(name, LongType(), not required)


# --- fixed values: field names of the landed documents ---
AVATARS = StructType([_text(size, True) for size in ("48x48", "24x24", "16x16", "32x32")])

USER = StructType([
    _text("accountId", True), _text("displayName", True), _text("emailAddress"),
    _text("self", True), StructField("avatarUrls", AVATARS, True), _flag("active"),
    _text("timeZone"), _text("accountType"),
])

PRIORITY = StructType([
    _text("id", True), _text("name", True), _text("self", True), _text("description"),
    _text("iconUrl"), _text("statusColor"),
])

ISSUE_TYPE = StructType([
    _text("id", True), _text("name", True), _text("self", True), _text("description"),
    _flag("subtask"), _text("iconUrl"),
])

STATUS_CATEGORY = StructType([
    _number("id", True), _text("key", True), _text("name", True), _text("colorName", True),
    _text("self"),
])

STATUS = StructType([
    _text("id", True), _text("name", True), _text("self", True), _text("description"),
    _text("iconUrl"), StructField("statusCategory", STATUS_CATEGORY, False),
])

PROJECT = StructType([
    _text("id", True), _text("key", True), _text("name", True), _text("self", True),
    _text("description"), _text("projectTypeKey"), StructField("avatarUrls", AVATARS, True),
    StructField("lead", USER, True), _text("url"), _flag("simplified"),
])

FIELD = StructType([
    _text("id", True), _text("key", True), _text("name", True), _flag("custom"),
    _flag("orderable"), _flag("navigable"), _flag("searchable"),
    StructField("schema", StructType([
        _text("type", True), _text("items"), _text("system"), _text("custom"), _number("customId"),
    ]), True),
    StructField("clauseNames", ArrayType(StringType()), True),
])

# `description` is text or a rich-text object; read as text, an object arrives as its JSON.
# `labels` are read as text too, so that odd labels do not spoil the document.
ISSUE_FIELDS = StructType([
    _text("summary", True), _text("description"), StructField("issuetype", ISSUE_TYPE, False),
    StructField("priority", PRIORITY, True), StructField("status", STATUS, False),
    StructField("assignee", USER, True), StructField("reporter", USER, False),
    _text("created", True), _text("updated", True), _text("resolutiondate"),
    StructField("project", PROJECT, True), _text("labels"),
])

ISSUE_DOCUMENT = StructType([
    _text("id", True), _text("key", True), _text("self", True),
    StructField("fields", ISSUE_FIELDS, False),
])

# Issues stay JSON text inside a page, so that no unknown field is lost on the way.
PAGE = StructType([
    _number("startAt", True), _number("maxResults", True), _number("total", True),
    StructField("issues", ArrayType(StringType()), False),
    _text("expand"), _text("names"), _text("schema"),
])

DIMENSIONS = {
    "project": PROJECT,
    "priority": PRIORITY,
    "issue_type": ISSUE_TYPE,
    "field": FIELD,
    "status_category": STATUS_CATEGORY,
    "user": USER,
}
# --- end of fixed values ---

ISSUES = StructType([
    _text("id", True), _text("issue_key", True), _text("summary", True), _text("description"),
    _text("status_name", True), _text("priority_name"), _text("issue_type_name", True),
    _text("project_key"), _text("project_name"), _text("reporter_display_name", True),
    _text("assignee_display_name"), StructField("created", TimestampType(), False),
    StructField("updated", TimestampType(), False),
    StructField("resolution_date", TimestampType(), True), _text("raw_json", True),
])

ISSUE_HISTORY = StructType([
    _number("history_id", True), _text("issue_id", True), _text("issue_key", True),
    _text("change_id", True), StructField("change_timestamp", TimestampType(), False),
    _text("author_account_id"), _text("author_display_name"), _text("author_email"),
    _text("field_name", True), _text("field_id"), _text("from_value"), _text("to_value"),
    _text("from_display_value"), _text("to_display_value"),
    StructField("created_at", TimestampType(), False),
])

SYNC_RUNS = StructType([
    _text("service", True), _number("run_id", True), StructField("start_time", TimestampType(), False),
    StructField("end_time", TimestampType(), False), _number("synced_count"), _number("new_count"),
    _number("updated_count"), _number("deleted_count"), _number("error_count"), _flag("is_success"),
    StructField("error_messages", ArrayType(StringType()), True),
])

SYNC_PROJECT_RUNS = StructType([
    _text("project_key", True), _number("synced_count"), _number("new_count"),
    _number("updated_count"), _number("error_count"),
    StructField("last_sync_time", TimestampType(), True),
])
