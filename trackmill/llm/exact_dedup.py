"""Exact deduplication by a tree merge of sorted digest runs.

Every task turns its rows into a run: one entry per different text, sorted by digest, with
the number of rows and the smallest and largest identifier.  The runs then meet in rounds.
``n = fan ** rounds`` nodes are numbered in base ``fan``; in round ``k`` the ``fan`` nodes
that differ in digit ``k`` alone exchange entries, each keeping those whose digest has its
own digit there, and merges what it got into one sorted run again.  After the last round a
node holds all entries of its digests.  A text that a third of all rows share is one entry
per run from the first level on, so no key is hot, and no node ever holds more than its
share of the different texts.  The nodes are bounded, since a shuffle has as many blocks as
the square of them: with more runs than nodes several runs share one from the start.

Entries are verified as they merge: equal SHA-256 digests must come with equal lengths and
equal second digests (BLAKE2b), otherwise the texts count as different; and every incoming
entry must be in order, otherwise the task fails.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import small_batches
from trackmill.session import durable

# Most runs that meet in one round, and the rows of a task that make one sorted run.
FAN = 16
RUN_ROWS = 500_000
# Nodes up to the next power of the fan; beyond as many runs, several begin at one node.
MOST_NODES = 4096

DIGESTED = "id long, run int, row long, digest binary, length long, check binary"
ENTRY = (
    "node int, digest binary, length long, check binary, size long, "
    "least long, least_row long, most long, most_row long, run int"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        lowered = [(text or b"").lower() for text in texts]  # of bytes: A-Z alone
        n = len(lowered)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                pa.array([part] * n, pa.int32()),
                pa.array([(part << 40) + at + i for i in range(n)], pa.int64()),
                pa.array([hashlib.sha256(text).digest() for text in lowered], pa.binary()),
                pa.array([len(text) for text in lowered], pa.int64()),
                pa.array([hashlib.blake2b(text, digest_size=8).digest() for text in lowered], pa.binary()),
            ],
            names=["id", "run", "row", "digest", "length", "check"],
        )
        at += n


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's identifier, its place and the digests of its text; written once."""
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return durable(narrow.mapInArrow(_digest, DIGESTED))


def _place(identifier: int | None, row: int) -> tuple:
    """Order of rows by identifier, absent ones apart, then by place."""
    return (identifier is not None, identifier or 0, row)


def _merge(old: list, new: list) -> list:
    """Two entries of one text as one."""
    size = old[3] + new[3]
    # Absent identifiers lose against any other, on either end.
    least = min((old, new), key=lambda e: (e[4] is None, e[4] or 0, e[5]))
    most = max((old, new), key=lambda e: _place(e[6], e[7]))
    return [*old[:3], size, least[4], least[5], most[6], most[7]]


def _batch(entries: list[list], node: int, run: int) -> pa.RecordBatch:
    columns = list(zip(*entries, strict=True))
    kinds = [pa.binary(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
    names = ["digest", "length", "check", "size", "least", "least_row", "most", "most_row"]
    arrays = [pa.array(list(values), kind) for values, kind in zip(columns, kinds, strict=True)]
    n = len(entries)
    return pa.RecordBatch.from_arrays(
        [pa.array([node] * n, pa.int32()), *arrays, pa.array([run] * n, pa.int32())],
        names=["node", *names, "run"],
    )


def _first_runs(nodes: int):
    """Rows of a task as sorted runs, each with one entry per different text."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list] = {}
        run = 0

        def out() -> Iterator[pa.RecordBatch]:
            entries = [found[key] for key in sorted(found)]
            for start in range(0, len(entries), 50_000):
                yield _batch(entries[start:start + 50_000], run % nodes, run)

        for batch in batches:
            for identifier, part, row, digest, length, check in zip(
                *[column.to_pylist() for column in batch.columns], strict=True
            ):
                run = part
                key, new = (digest, length, check), [digest, length, check, 1, identifier, row, identifier, row]
                old = found.get(key)
                found[key] = new if old is None else _merge(old, new)
            if len(found) >= RUN_ROWS:
                yield from out()
                found.clear()
        yield from out()

    return runs


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries of one node with those of equal texts made one."""
    last: list | None = None
    node, ready = 0, []
    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        for at, *entry, _run in zip(*columns, strict=True):
            if last is not None and entry[:3] == last[:3]:
                last = _merge(last, entry)
            else:
                if last is not None:
                    if entry[:3] < last[:3]:
                        raise ValueError("a digest run is out of order")
                    ready.append(last)
                last = entry
            node = at
        if len(ready) >= 50_000:
            yield _batch(ready, node, node)
            ready = []
    if last is not None:
        ready.append(last)
    if ready:
        yield _batch(ready, node, node)


def rounds_for(runs: int, fan: int = FAN) -> int:
    """Rounds until every node of ``fan ** rounds`` has met every run."""
    rounds = 1
    while fan ** rounds < runs:
        rounds += 1
    return rounds


def narrowest(runs: int, rounds: int) -> int:
    """The smallest fan with which ``rounds`` rounds are enough."""
    fan = 2
    while fan ** rounds < runs:
        fan += 1
    return fan


def tree_merge(runs: DataFrame, rounds: int, fan: int = FAN) -> DataFrame:
    """One entry per different text, each on the node that its digest names."""
    nodes, level = fan ** rounds, runs
    for k in range(rounds):
        unit = fan ** k
        # Digits come from the first four bytes of the digest, which are uniform.
        number = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
        own = F.floor(number / F.lit(unit)) % fan
        node = F.col("node")
        target = (node - (F.floor(node / F.lit(unit)) % fan) * unit + own * unit).cast("int")
        level = (
            level.withColumn("node", target)
            .repartitionById(nodes, F.col("node"))
            .sortWithinPartitions("node", "digest", "length", "check")
            .mapInArrow(_merged, ENTRY)
        )
    return level


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", fan: int = FAN,
    most_nodes: int = MOST_NODES,
) -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``, ``sha256``.

    Texts are equal when identical after lower-casing ``A``-``Z``; an absent text counts as
    empty.  ``keep`` names the identifier that stays, ``smallest`` or ``largest``; an absent
    identifier stays only where no row of the group has one.  Of repeated identifiers one
    row stays, so every group keeps exactly one row.  An empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    rows = digest_rows(docs, id_col, text_col)
    meeting = min(rows.rdd.getNumPartitions(), most_nodes)
    rounds = rounds_for(meeting, fan)
    fan = narrowest(meeting, rounds)
    runs = durable(rows.mapInArrow(_first_runs(fan ** rounds), ENTRY))
    winner = ("least", "least_row") if keep == "smallest" else ("most", "most_row")
    groups = tree_merge(runs, rounds, fan).select(
        "digest", "length", "check", F.col("size").alias("group_size"),
        F.col(winner[0]).alias("keep_id"), F.col(winner[1]).alias("keep_row"),
    )
    # Back the way they came: to each run, where a text is one entry, then to its rows.
    keys = ["digest", "length", "check"]
    of_run = runs.select("run", *keys).distinct().join(groups, keys)
    told = rows.join(of_run, ["run", *keys])
    return told.select(
        "id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("sha256"),
    )
