"""Filter specifications that become Column predicates.

A specification is a bag of optional conditions, all of which must hold; one that is
unset or empty is no condition.  Every predicate except text search reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.functions.changes import CHANGE_TYPES, change_type
from trackmill.functions.instants import Instant, as_utc, instant
from trackmill.functions.text import contains_text

# Lists longer than this join as a table instead of travelling inside the plan.
INLINE_KEYS = 1000


# The month that stored history is partitioned by.
MONTH = "change_month"


def months_between(start: Instant | None = None, end: Instant | None = None) -> Column:
    """Bound on the partition column for changes from ``start`` to ``end``."""
    bounds = []
    if start is not None:
        bounds.append(F.col(MONTH) >= F.lit(as_utc(start).date().replace(day=1)))
    if end is not None:
        bounds.append(F.col(MONTH) <= F.lit(as_utc(end).date().replace(day=1)))
    return all_of(bounds)


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(and_, predicates, F.lit(True))


def key_table(spark: SparkSession, name: str, keys: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(key,) for key in keys], f"{name} string").distinct()


@dataclass(frozen=True)
class DateRange:
    """Closed range of instants."""

    start: Instant
    end: Instant

    @classmethod
    def last_days(cls, days: int, as_of: Instant) -> DateRange:
        return cls(as_utc(as_of) - timedelta(days=days), as_of)

    @classmethod
    def last_hours(cls, hours: int, as_of: Instant) -> DateRange:
        return cls(as_utc(as_of) - timedelta(hours=hours), as_of)

    def validate(self) -> DateRange:
        if as_utc(self.start) > as_utc(self.end):
            raise ValueError("start of the range is after its end")
        return self

    def condition(self, column: str, date_column: str | None = None) -> Column:
        """Both ends included.  ``date_column`` names a partition column holding the
        date of ``column``; Spark does not infer that bound from the timestamp."""
        inside = F.col(column).between(instant(self.start), instant(self.end))
        if date_column:
            first, last = as_utc(self.start).date(), as_utc(self.end).date()
            inside = F.col(date_column).between(F.lit(first), F.lit(last)) & inside
        return inside


@dataclass(frozen=True)
class IssueFilter:
    project_keys: Sequence[str] = ()
    statuses: Sequence[str] = ()
    priorities: Sequence[str] = ()
    issue_types: Sequence[str] = ()
    reporters: Sequence[str] = ()
    assignees: Sequence[str] = ()
    created_range: DateRange | None = None
    updated_range: DateRange | None = None
    summary_contains: str | None = None
    description_contains: str | None = None
    labels: Sequence[str] = ()
    limit: int | None = None
    offset: int = 0
    sort_order: str = "created_desc"

    LISTS = (
        ("project_keys", "project_key"),
        ("statuses", "status_name"),
        ("priorities", "priority_name"),
        ("issue_types", "issue_type_name"),
        ("reporters", "reporter_display_name"),
        ("assignees", "assignee_display_name"),
    )

    def is_empty(self) -> bool:
        """No condition set; order and paging do not count as conditions."""
        lists = any(getattr(self, name) for name, _ in self.LISTS) or bool(self.labels)
        ranges = self.created_range is not None or self.updated_range is not None
        texts = self.summary_contains is not None or self.description_contains is not None
        return not (lists or ranges or texts)

    def predicates(self, created_date: str | None = None) -> list[Column]:
        found = [
            F.col(column).isin(list(values))
            for name, column in self.LISTS
            if 0 < len(values := getattr(self, name)) <= INLINE_KEYS
        ]
        if self.created_range is not None:
            found.append(self.created_range.condition("created", created_date))
        if self.updated_range is not None:
            found.append(self.updated_range.condition("updated"))
        if self.summary_contains is not None:
            found.append(contains_text(F.col("summary"), self.summary_contains))
        if self.description_contains is not None:
            found.append(contains_text(F.col("description"), self.description_contains))
        if self.labels:
            wanted = F.array(*[F.lit(label) for label in self.labels])
            found.append(F.arrays_overlap(F.col("labels"), wanted))
        return found

    def apply(self, issues: DataFrame, created_date: str | None = None) -> DataFrame:
        matching = issues.where(all_of(self.predicates(created_date)))
        for name, column in self.LISTS:
            values = getattr(self, name)
            if len(values) > INLINE_KEYS:
                keys = key_table(issues.sparkSession, column, values)
                matching = matching.join(keys, column, "left_semi")
        return matching.select(*issues.columns)


@dataclass(frozen=True)
class HistoryFilter:
    issue_keys: Sequence[str] = ()
    field_names: Sequence[str] = ()
    authors: Sequence[str] = ()
    date_range: DateRange | None = None
    change_types: Sequence[str] = ()
    limit: int | None = None
    sort_order: str = "timestamp_desc"

    LISTS = (
        ("issue_keys", "issue_key"),
        ("field_names", "field_name"),
        ("authors", "author_account_id"),
    )

    def __post_init__(self) -> None:
        if self.limit is not None and self.limit < 1:
            raise ValueError("limit must be at least 1")
        if self.date_range is not None:
            self.date_range.validate()
        unknown = set(self.change_types) - set(CHANGE_TYPES)
        if unknown:
            raise ValueError(f"unknown change types: {sorted(unknown)}")

    def predicates(self, by_month: bool = False) -> list[Column]:
        """``by_month`` adds the bound on the month that stored history is partitioned by."""
        found = [
            F.col(column).isin(list(values))
            for name, column in self.LISTS
            if 0 < len(values := getattr(self, name)) <= INLINE_KEYS
        ]
        if self.date_range is not None:
            found.append(self.date_range.condition("change_timestamp"))
            if by_month:
                found.append(months_between(self.date_range.start, self.date_range.end))
        if self.change_types:
            found.append(change_type().isin(list(self.change_types)))
        return found

    def apply(self, history: DataFrame) -> DataFrame:
        matching = history.where(all_of(self.predicates(MONTH in history.columns)))
        for name, column in self.LISTS:
            values = getattr(self, name)
            if len(values) > INLINE_KEYS:
                keys = key_table(history.sparkSession, column, values)
                matching = matching.join(keys, column, "left_semi")
        return matching.select(*history.columns)


@dataclass(frozen=True)
class TimeWindow:
    """Issues created or updated in a span, either end of which may be open."""

    since: Instant | None = None
    until: Instant | None = None
    granularity_hours: int = 1
    by_created: bool = True
    by_updated: bool = True
    whole_minutes: bool = False
    excluded_keys: Sequence[str] = field(default=())

    def __post_init__(self) -> None:
        if self.since is not None and self.until is not None:
            if as_utc(self.since) > as_utc(self.until):
                raise ValueError("the window starts after it ends")
        if self.granularity_hours < 1:
            raise ValueError("granularity must be at least one hour")
        if not (self.by_created or self.by_updated):
            raise ValueError("a window needs the created or the updated column")

    @classmethod
    def last_hours(cls, hours: int, as_of: Instant) -> TimeWindow:
        return cls(as_utc(as_of) - timedelta(hours=hours), as_of, 1)

    @classmethod
    def last_days(cls, days: int, as_of: Instant) -> TimeWindow:
        return cls(as_utc(as_of) - timedelta(days=days), as_of, 24)

    @classmethod
    def dates(cls, start: Instant, end: Instant) -> TimeWindow:
        return cls(start, end, 24)

    @classmethod
    def incremental_since(cls, last_sync: Instant, as_of: Instant) -> TimeWindow:
        return cls(last_sync, as_of, 1)

    def excluding(self, keys: Sequence[str]) -> TimeWindow:
        return replace(self, excluded_keys=tuple(keys))

    def _bound(self, value: Instant) -> Column:
        value = as_utc(value)
        return instant(value.replace(second=0, microsecond=0) if self.whole_minutes else value)

    def _inside(self, column: str) -> Column:
        bounds = []
        if self.since is not None:
            bounds.append(F.col(column) >= self._bound(self.since))
        if self.until is not None:
            bounds.append(F.col(column) <= self._bound(self.until))
        return all_of(bounds)

    def condition(self) -> Column:
        if self.by_created and self.by_updated:
            return self._inside("created") | self._inside("updated")
        return self._inside("created" if self.by_created else "updated")

    def apply(self, issues: DataFrame) -> DataFrame:
        matching = issues.where(self.condition())
        if not self.excluded_keys:
            return matching
        if len(self.excluded_keys) <= INLINE_KEYS:
            listed = F.col("issue_key").isin(list(self.excluded_keys))
            return matching.where(~F.coalesce(listed, F.lit(False)))
        keys = key_table(issues.sparkSession, "issue_key", self.excluded_keys)
        return matching.join(keys, "issue_key", "left_anti").select(*issues.columns)


def in_chunk(start: Instant, end: Instant, created: bool = True, updated: bool = True,
             last: bool = False) -> Column:
    """Rows of one time chunk: its start included, its end only for the last chunk, so
    that a row on a border counts once.  With neither column chosen, created is used."""
    def inside(column: str) -> Column:
        upper = F.col(column) <= instant(end) if last else F.col(column) < instant(end)
        return (F.col(column) >= instant(start)) & upper

    columns = [name for name, chosen in (("created", created), ("updated", updated)) if chosen]
    return reduce(lambda a, b: a | b, [inside(name) for name in columns or ["created"]])


# --- search idioms -----------------------------------------------------------


def unresolved() -> Column:
    return F.col("resolution_date").isNull()


def open_issues(closed_status: str) -> Column:
    """Neither resolved nor in the closing status."""
    return unresolved() & (F.col("status_name") != closed_status)


def updated_within(days: int, as_of: Instant) -> Column:
    return F.col("updated") >= instant(as_utc(as_of) - timedelta(days=days))


def of_type_not_in_status(issue_type: str, status: str) -> Column:
    return (F.col("issue_type_name") == issue_type) & (F.col("status_name") != status)
