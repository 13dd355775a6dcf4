"""Expressions over change-history rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackmill.functions.text import or_default

# --- fixed values: change types and their display labels ---
STATUS_CHANGE = "StatusChange"
ASSIGNEE_CHANGE = "AssigneeChange"
PRIORITY_CHANGE = "PriorityChange"
CUSTOM_FIELD = "CustomField"
FIELD_UPDATE = "FieldUpdate"

CHANGE_LABELS = {
    STATUS_CHANGE: "Status Changes",
    ASSIGNEE_CHANGE: "Assignee Changes",
    PRIORITY_CHANGE: "Priority Changes",
    CUSTOM_FIELD: "Custom Field Changes",
    FIELD_UPDATE: "Other Changes",
}

NO_AUTHOR = "System"
NO_VALUE = "None"
# --- end of fixed values ---

CHANGE_TYPES = tuple(CHANGE_LABELS)


def change_type(field_name: str = "field_name", field_id: str = "field_id") -> Column:
    name = F.col(field_name)
    return (
        F.when(name == "status", STATUS_CHANGE)
        .when(name == "assignee", ASSIGNEE_CHANGE)
        .when(name == "priority", PRIORITY_CHANGE)
        .when(F.col(field_id).isNotNull(), CUSTOM_FIELD)
        .otherwise(FIELD_UPDATE)
    )


def change_label(kind: Column) -> Column:
    """Display label of a change type."""
    label = F.lit(CHANGE_LABELS[FIELD_UPDATE])
    for name, text in CHANGE_LABELS.items():
        if name != FIELD_UPDATE:
            label = F.when(kind == name, text).otherwise(label)
    return label


def change_sentence() -> Column:
    """One line describing the change, with display defaults for missing parts."""
    return F.format_string(
        "%s: %s changed %s from '%s' to '%s'",
        F.date_format("change_timestamp", "yyyy-MM-dd HH:mm:ss"),
        or_default(F.col("author_display_name"), NO_AUTHOR),
        F.col("field_name"),
        or_default(F.col("from_display_value"), NO_VALUE),
        or_default(F.col("to_display_value"), NO_VALUE),
    )


def author_struct() -> Column:
    """Author as one struct, present only when both id and name are known."""
    known = F.col("author_account_id").isNotNull() & F.col("author_display_name").isNotNull()
    return F.when(
        known,
        F.struct(
            F.col("author_account_id").alias("account_id"),
            F.col("author_display_name").alias("display_name"),
            F.col("author_email").alias("email_address"),
        ),
    )


def flat_author(author: str = "author") -> list[Column]:
    """The three flat columns of an author struct."""
    return [
        F.col(f"{author}.account_id").alias("author_account_id"),
        F.col(f"{author}.display_name").alias("author_display_name"),
        F.col(f"{author}.email_address").alias("author_email"),
    ]
