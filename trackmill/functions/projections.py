"""Column selection and small derived values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ---
# What a synchronisation asks for when some fields are excluded.
DEFAULT_FIELDS = (
    "key", "summary", "status", "priority", "issuetype", "reporter", "created", "updated",
)

# Typed fields of an issue document; every other key is a custom field.
TYPED_FIELDS = (
    "summary", "description", "issuetype", "priority", "status", "assignee", "reporter",
    "created", "updated", "resolutiondate", "project",
)

# Where each requested field lives in the flat table.
FIELD_COLUMNS = {
    "key": "issue_key",
    "summary": "summary",
    "description": "description",
    "status": "status_name",
    "priority": "priority_name",
    "issuetype": "issue_type_name",
    "project": "project_key",
    "reporter": "reporter_display_name",
    "assignee": "assignee_display_name",
    "created": "created",
    "updated": "updated",
    "resolutiondate": "resolution_date",
}
# --- end of fixed values ---

LIGHT_COLUMNS = ("id", "issue_key", "summary")


def select_fields(issues: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Only the named fields, so that a scan reads nothing else."""
    return issues.select(*[FIELD_COLUMNS.get(field, field) for field in fields])


def without_fields(issues: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """The default fields less the excluded ones."""
    return select_fields(issues, [field for field in DEFAULT_FIELDS if field not in excluded])


def light(issues: DataFrame) -> DataFrame:
    return issues.select(*LIGHT_COLUMNS)


def custom_fields(fields_json: Column) -> Column:
    """Map of custom field to value from the JSON of ``fields``.

    Strings come as text, nested values as their JSON, JSON null as null.
    """
    everything = F.from_json(fields_json, "map<string,string>")
    return F.map_filter(everything, lambda key, _: ~key.isin(*TYPED_FIELDS))


def labels(custom: Column) -> Column:
    """Labels kept among the custom fields, as an array."""
    return F.from_json(F.element_at(custom, F.lit("labels")), "array<string>")


def percent(part: Column, total: Column) -> Column:
    """Share in percent; 0 when there is nothing to share."""
    return F.when(total > 0, F.lit(100.0) * part / total).otherwise(F.lit(0.0))


def computed_once(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with the given columns, each evaluated once per row.

    Spark moves filters below a projection and then repeats the projected expression at
    every place that uses it, which for JSON parsing means parsing many times.  It moves
    nothing below a generator, so the values pass through one of a single element.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select("*", F.inline(F.array(row)))
