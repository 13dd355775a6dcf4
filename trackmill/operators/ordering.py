"""Sort orders, top-k, paging and whole-table positions.

Ties are always broken by unique columns, so a limit or a page has one right answer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmill.functions.instants import Instant, instant
from trackmill.operators.filters import HistoryFilter, IssueFilter
from trackmill.session import durable

ISSUE_SORTS = {
    "created_asc": ("created", True),
    "created_desc": ("created", False),
    "updated_asc": ("updated", True),
    "updated_desc": ("updated", False),
    "key_asc": ("issue_key", True),
    "key_desc": ("issue_key", False),
    "priority_asc": ("priority_name", True),
    "priority_desc": ("priority_name", False),
}

HISTORY_SORTS = {
    "timestamp_asc": ("change_timestamp", True),
    "timestamp_desc": ("change_timestamp", False),
    "issue_key": ("issue_key", True),
    "field_name": ("field_name", True),
}

ISSUE_TIES = ("issue_key", "id")
HISTORY_TIES = ("issue_key", "change_id", "field_name", "history_id")


def _directed(column: Column, ascending: bool) -> Column:
    return column.asc_nulls_last() if ascending else column.desc_nulls_last()


def issue_order(sort_order: str, ranks: Mapping[str, int] | None = None) -> list[Column]:
    """Sort columns for issues.  Priority sorts by its name, absent last in both
    directions; ``ranks`` gives priorities an order of their own."""
    name, ascending = ISSUE_SORTS[sort_order]
    column = F.col(name)
    if name == "priority_name" and ranks:
        column = F.coalesce(*[F.when(F.col(name) == key, F.lit(rank)) for key, rank in ranks.items()])
    return [_directed(column, ascending), *[F.col(tie) for tie in ISSUE_TIES if tie != name]]


def history_order(sort_order: str, ties: Sequence[str] = HISTORY_TIES) -> list[Column]:
    name, ascending = HISTORY_SORTS[sort_order]
    return [_directed(F.col(name), ascending), *[F.col(tie) for tie in ties if tie != name]]


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Number all rows 1, 2, 3, … in the given order without gathering them anywhere."""
    return numbered(df.orderBy(*order), name)


def numbered(df: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of a sorted table 1, 2, 3, … in the order they are in.

    Rows are checkpointed as they are; a row's position is the size of the partitions
    before its own plus its place inside it.
    """
    placed = durable(df).withColumn("_serial", F.monotonically_increasing_id())
    placed = placed.select(
        *df.columns,
        F.shiftright("_serial", 33).alias("_part"),
        F.col("_serial").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per partition: small enough for one window task and to broadcast.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_start") + F.col("_row") + 1).alias(name))


def take_page(
    df: DataFrame,
    order: Sequence[Column],
    limit: int | None = None,
    offset: int = 0,
    positions: bool = False,
) -> DataFrame:
    """Sorted rows ``offset+1 … offset+limit``; beyond the last row there is nothing.

    By itself this starts no job: it is a top-k, which keeps the page and all rows before it
    in every task and is meant for small pages near the start.  With ``positions`` the page
    is cut from whole-table positions instead, which writes a checkpoint of the sorted
    table at once, for which the session needs ``spark.checkpoint.dir``.  Long walks do
    better with :func:`page_after`.
    """
    if limit is None and not offset:
        return df.orderBy(*order)
    if not positions:
        ordered = df.orderBy(*order)
        ordered = ordered.offset(offset) if offset else ordered
        return ordered if limit is None else ordered.limit(limit)
    position = F.col("_position")
    wanted = position > offset
    if limit is not None:
        wanted = wanted & (position <= offset + limit)
    return with_position(df, order, "_position").where(wanted).orderBy("_position").drop("_position")


def assign_pages(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """Every row with its ``page`` and its ``position``, as a full page walk meets them."""
    if size < 1:
        raise ValueError("page size must be at least 1")
    return with_position(df, order).withColumn("page", F.floor((F.col("position") - 1) / F.lit(size)).cast("long"))


def page_after(issues: DataFrame, last_created: Instant, last_key: str, size: int) -> DataFrame:
    """Next page of a created-ascending walk, found by the last row seen.  The scan
    skips what was already read, which an offset cannot."""
    bound = instant(last_created)
    created = F.col("created")
    rest = issues.where(
        (created >= bound) & ((created > bound) | (F.col("issue_key") > last_key))
    )
    return take_page(rest, issue_order("created_asc"), size)


def load_issues(
    issues: DataFrame, spec: IssueFilter, created_date: str | None = None, positions: bool = False
) -> DataFrame:
    """Filter, order and page issues as ``spec`` says; ``positions`` as in :func:`take_page`."""
    matching = spec.apply(issues, created_date)
    return take_page(matching, issue_order(spec.sort_order), spec.limit, spec.offset, positions)


def load_history(
    history: DataFrame, spec: HistoryFilter, ties: Sequence[str] = HISTORY_TIES
) -> DataFrame:
    """Filter, order and limit history as ``spec`` says."""
    return take_page(spec.apply(history), history_order(spec.sort_order, ties), spec.limit)


def latest(df: DataFrame, timestamp: str, ties: Sequence[str] = ()) -> DataFrame:
    """The most recent record."""
    order = [F.col(timestamp).desc_nulls_last(), *[F.col(tie).desc() for tie in ties]]
    return df.orderBy(*order).limit(1)
