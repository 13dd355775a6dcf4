"""Text search and text shaping."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_text(column: Column, term: str) -> Column:
    """Case-insensitive search for ``term`` taken literally; null never matches.

    Not LIKE: ``%`` and ``_`` in the term are ordinary characters.
    """
    return F.contains(F.lower(column), F.lower(F.lit(term)))


def contains_any(column: Column, terms: Iterable[str]) -> Column:
    """Does the text hold at least one of the terms?"""
    return reduce(lambda found, term: found | contains_text(column, term), terms, F.lit(False))


def any_column_contains(columns: Iterable[Column], term: str) -> Column:
    """Is the term found in at least one column, null columns aside?"""
    hits = (F.coalesce(contains_text(column, term), F.lit(False)) for column in columns)
    return reduce(lambda found, hit: found | hit, hits)


def preview(column: Column, length: int) -> Column:
    """First ``length`` characters, for display."""
    return F.substring(column, 1, length)


def decoded_text(json_value: Column) -> Column:
    """Readable text of a VARIANT value: a string is itself, anything else its JSON."""
    return F.when(
        F.schema_of_variant(json_value) != "VOID",
        F.coalesce(string_or_null(json_value), F.to_json(json_value)),
    )


def string_or_null(json_value: Column) -> Column:
    """The text of a VARIANT that holds a string; null for any other JSON type."""
    return F.when(
        F.schema_of_variant(json_value) == "STRING",
        F.try_variant_get(json_value, "$", "string"),
    )


def or_default(column: Column, default: str) -> Column:
    """Display default for a missing value."""
    return F.coalesce(column, F.lit(default))
