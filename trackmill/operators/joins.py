"""Joins between issues, history, known keys and time chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from trackmill.functions.instants import Instant, as_utc, elapsed_micros, instant
from trackmill.operators.scans import PART, inside, ranged, sums_before
from trackmill.session import durable

# A key with at least this share of the rows is spread over SALTS tasks.
HOT_SHARE = 0.01
SALTS = 64


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """One row with an array ``hot`` of the keys that hold at least ``share`` of the rows.

    A mergeable sketch of frequent items finds them in one pass over the key column; at
    most ``1/share`` keys can qualify.  It only decides how rows are spread, never which
    rows a join returns.
    """
    candidates = int(2 / share)
    sketch = F.expr(f"approx_top_k({key}, {candidates}, {20 * candidates})")
    found = df.agg(sketch.alias("_top"), F.count("*").alias("_rows"))
    heavy = F.filter("_top", lambda item: item["count"] >= F.col("_rows") * share)
    return found.select(F.transform(heavy, lambda item: item["item"]).alias("hot"))


def _atomic_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: DataFrame | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join whose left side may have very frequent keys; ``right`` has each key once.

    Adaptive execution splits such keys by itself wherever both sides are shuffled, so the
    joins below are plain; this one is for a caller that has switched it off.

    Left rows with a hot first key are dealt out over ``salts`` tasks and the matching
    right rows are copied to each of them.  All other keys get salt 0.  ``how`` is inner,
    left, left_semi or left_anti.
    """
    key = keys[0]
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    hot = hot_keys(left, key) if hot is None else hot
    is_hot = F.coalesce(F.array_contains(hot.scalar(), F.col(key)), F.lit(False))
    # Different rows part by their content, exact copies by the partition they come from;
    # both stay the same when a task runs again.
    content = F.xxhash64(F.spark_partition_id(), *_atomic_columns(left))
    dealt = F.when(is_hot, F.pmod(content, F.lit(salts)).cast("int")).otherwise(F.lit(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.withColumn("_salt", dealt)
    salted_right = right.withColumn("_salt", F.explode(copies))
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    return salted_left.join(salted_right, [*keys, "_salt"], how).select(*left.columns, *added)


def join_history(
    issues: DataFrame, history: DataFrame, project_key: str | None = None,
    field_name: str | None = None,
) -> DataFrame:
    """Issues with their changes, newest change first.

    Both filters run below the join.  Adaptive execution splits the history of a hot
    issue, since each issue occurs once on the other side.
    """
    if project_key is not None:
        issues = issues.where(F.col("project_key") == project_key)
    if field_name is not None:
        history = history.where(F.col("field_name") == field_name)
    changes = history.select(
        F.col("issue_id").alias("id"), "change_id", "field_name", "to_display_value",
        "change_timestamp",
    )
    joined = issues.select("id", "issue_key", "summary").join(changes, "id")
    return joined.orderBy(F.col("change_timestamp").desc(), "issue_key", "change_id")


def exclude_known(issues: DataFrame, known: DataFrame, key: str = "issue_key") -> DataFrame:
    """Issues whose key is not known yet; a null key is kept."""
    return issues.join(known.select(key), key, "left_anti").select(*issues.columns)


def exclude_unchanged(
    issues: DataFrame, known: DataFrame, key: str = "issue_key", version: str = "updated"
) -> DataFrame:
    """Issues that are new or carry another version than the known one."""
    versions = known.select(key, version)
    return issues.join(versions, [key, version], "left_anti").select(*issues.columns)


def keep_known(issues: DataFrame, known: DataFrame, key: str = "issue_key") -> DataFrame:
    """Issues whose key is known already."""
    return issues.join(known.select(key), key, "left_semi").select(*issues.columns)


def classify(
    issues: DataFrame, known: DataFrame, key: str = "issue_key", version: str | None = None, few: bool = False
) -> DataFrame:
    """Mark every fetched issue as ``updated`` when its key is known, else ``new``.

    With ``version``, issues that a known row has in the same version are left out by the
    same join.  With ``few`` the fetched issues are few beside the known: these are reduced to
    the fetched keys before they are grouped, which reads the fetched issues twice.
    """
    touched = known.select(key, *([version] if version else []))
    if few:
        touched = touched.join(issues.select(key), key, "left_semi")
    seen = F.collect_set(version) if version else F.lit(True)
    flags = touched.groupBy(key).agg(seen.alias("_known"))
    marked = issues.join(flags, key, "left")
    if version:
        marked = marked.where(~F.coalesce(F.array_contains("_known", F.col(version)), F.lit(False)))
    kind = F.when(F.col("_known").isNotNull(), "updated").otherwise("new")
    return marked.select(*issues.columns, kind.alias("sync_kind"))


def chunk_index(ts: Column, start: Instant, end: Instant, hours: int) -> Column:
    """Number of the fixed-width chunk that holds ``ts``; null outside the range.

    Chunks are half-open except that the last one holds the end of the range.
    """
    width = hours * 3_600_000_000
    span = (as_utc(end) - as_utc(start))
    last = max(-(-(span.days * 86_400_000_000 + span.seconds * 1_000_000 + span.microseconds) // width) - 1, 0)
    index = F.floor(elapsed_micros(instant(start), ts) / F.lit(width)).cast("long")
    inside = (ts >= instant(start)) & (ts <= instant(end)) & (instant(start) < instant(end))
    return F.when(inside, F.least(index, F.lit(last).cast("long")))


def assign_chunks(
    df: DataFrame, chunks: DataFrame, timestamp: str, keep: Sequence[str], bin_hours: int = 24
) -> DataFrame:
    """Rows with the chunk they fall in: from its start to before its end, and to its end for
    the chunk that ends last.

    Chunks are laid over fixed bins, so that the join is an equality on the bin and only
    rows of the same bin are compared.
    """
    def bin_of(ts: Column) -> Column:
        return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(bin_hours * 3_600_000_000)).cast("long")

    real = chunks.where(F.col("chunk_start") < F.col("chunk_end"))
    last = F.col("chunk_end") == real.agg(F.max("chunk_end")).scalar()
    before_end = F.col("chunk_end") - F.expr("INTERVAL '0.000001' SECOND")
    bins = real.withColumn("_until", F.when(last, F.col("chunk_end")).otherwise(before_end)).withColumn(
        "_bin", F.explode(F.sequence(bin_of(F.col("chunk_start")), bin_of(F.col("_until"))))
    )
    rows = df.select(*keep, timestamp).withColumn("_bin", bin_of(F.col(timestamp)))
    inside = F.col(timestamp).between(F.col("chunk_start"), F.col("_until"))
    return rows.join(bins, "_bin").where(inside).drop("_bin", "_until")


def sweep_chunks(df: DataFrame, chunks: DataFrame, timestamp: str, keep: Sequence[str]) -> DataFrame:
    """Rows with every chunk they fall in, for chunks of any length that may overlap: from its
    start to before its end, and to its end for the chunks that end last.

    Starts, ends and rows are sorted together by time and swept once.  Rows with no start
    or end between them fall in the same chunks: they are one slot.  The sweep numbers the
    slots that have rows, and a chunk is open over a run of these numbers, from the one after
    its start to the one at its end.  So a chunk is repeated once for each slot in which it is open
    and which has rows, never for the time that it covers, and the join is an equality on the
    slot.  A slot that goes on behind the end of a range of the sweep is counted anew there,
    with the same chunks open.  Rows without a time and chunks without length fall out.
    """
    real = durable(chunks.where(F.col("chunk_start") < F.col("chunk_end")).withColumn("_chunk", F.monotonically_increasing_id()))
    closed = F.col("chunk_end") == real.agg(F.max("chunk_end")).scalar()
    nothing = F.lit(None)
    row = F.struct(*[F.col(name) for name in dict.fromkeys([*keep, timestamp])])
    rows = df.where(F.col(timestamp).isNotNull())
    # At one time ends and starts come first, then rows, then the ends that hold their rows.
    points = rows.select(
        F.col(timestamp).alias("_at"), F.lit(1).alias("_kind"), nothing.cast("long").alias("_chunk"),
        nothing.cast("boolean").alias("_begins"), row.alias("_row"),
    ).withColumn("_spread", F.xxhash64("_row"))
    kind = points.schema["_row"].dataType

    def marks(at: str, order: Column, begins: bool) -> DataFrame:
        return real.select(
            F.col(at).alias("_at"), order.cast("int").alias("_kind"), "_chunk", F.lit(begins).alias("_begins"),
            nothing.cast(kind).alias("_row"), F.col("_chunk").alias("_spread"),
        )

    events = points.unionByName(marks("chunk_start", F.lit(0), True)).unionByName(
        marks("chunk_end", F.when(closed, 2).otherwise(0), False)
    )
    order = [F.col("_at"), F.col("_kind"), F.col("_spread")]
    run = inside(order)
    is_row = F.col("_kind") == 1
    opens = is_row & ~F.coalesce(F.lag(is_row).over(run), F.lit(False))
    placed = ranged(events, order).withColumn("_opens", opens.cast("long"))
    # One row per range of the sweep.
    before = F.broadcast(sums_before(placed, _slots=F.col("_opens")))
    swept = durable(placed.join(before, PART).withColumn("_slot", F.col("_slots") + F.sum("_opens").over(run)))
    spans = swept.where("_kind <> 1").groupBy("_chunk").agg(
        (F.max(F.when(F.col("_begins"), F.col("_slot"))) + 1).alias("_from"),
        F.max(F.when(~F.col("_begins"), F.col("_slot"))).alias("_to"),
    )
    held = spans.where("_from <= _to").select("_chunk", F.explode(F.sequence("_from", "_to")).alias("_slot"))
    in_slots = swept.where("_kind = 1").select("_slot", "_row.*").join(held, "_slot")
    return in_slots.join(real, "_chunk").drop("_chunk", "_slot")
