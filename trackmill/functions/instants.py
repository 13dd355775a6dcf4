"""Instants as literals, parsing, formatting and durations."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = datetime | date | str

# RFC 3339 date-time with a mandatory offset, written Z, +00:00 or +0000.
_INSTANT = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:?\d{2})$"
_MINUTE = "yyyy-MM-dd HH:mm"


def as_utc(value: Instant) -> datetime:
    """``value`` as a zone-less UTC datetime; text is ISO 8601."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def instant(value: Instant) -> Column:
    """Timestamp literal.

    It is zone-less, so Spark adapts the literal and not the column whichever of the two
    timestamp types the column has, and the comparison still reaches the parquet scan.
    """
    return F.expr(f"TIMESTAMP_NTZ '{as_utc(value).isoformat(sep=' ')}'")


def parse_instant(text: Column) -> Column:
    """Change-log timestamp; null when it is malformed or has no offset."""
    return F.when(text.rlike(_INSTANT), text.try_cast("timestamp"))


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, _MINUTE)


def parse_minute(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(_MINUTE)).cast("timestamp_ntz")


def elapsed_micros(start: Column, end: Column) -> Column:
    return F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds, cut towards zero."""
    return (elapsed_micros(start, end) / F.lit(1_000_000)).cast("long")


def elapsed_hours(start: Column, end: Column) -> Column:
    return elapsed_seconds(start, end) / F.lit(3600.0)


def run_seconds(start: Column, end: Column) -> Column:
    """Run time in seconds at millisecond precision."""
    return (elapsed_micros(start, end) / F.lit(1000)).cast("long") / F.lit(1000.0)
