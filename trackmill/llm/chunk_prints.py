"""Document fingerprints by content-defined chunking.

A gear hash rolls over a text's bytes; it depends on the last ``SPAN`` bytes only.  A chunk ends
where the hash has enough zero bits: more are asked for below the normal length and fewer
beyond it, which draws lengths towards the normal one, and no chunk is shorter than
``LEAST`` or longer than ``MOST`` bytes.  Since ends depend on nearby content, an insertion
changes the chunks around it and leaves the others.  A fingerprint is the set of the chunks'
digests with their lengths; the containment of one in another is the length that they share
against the length of the first.

Comparing each document with the one behind it needs no window over the table: documents are
dealt into ranges of their order, each range gets a copy of the next one's first document,
and a task reads its range once from front to back.  The ranges are cut by identifier and
by the text's hash, so that many rows of one identifier do not meet in one task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import partitions_of, small_batches

# Lengths of chunks in bytes, and bytes that the rolling hash sees.
LEAST, NORMAL, MOST = 8, 32, 256
SPAN = 32
# Zero bits asked for below the normal length and beyond it.
STRICT_BITS, LOOSE_BITS = 6, 3
SEED = 42
#: Low bits of a fingerprint's number: the chunk's length.
LENGTH_BITS = 16

GEAR = np.random.default_rng(SEED).integers(0, 1 << 32, 256, np.uint32)
_TOP = np.uint32(32)


def rolling(data: bytes) -> np.ndarray:
    """The gear hash at each byte: the sum over the last ``SPAN`` bytes of their gears, each
    shifted by its distance."""
    found = GEAR[np.frombuffer(data, np.uint8)]
    reach = 1
    while reach < SPAN:
        moved = found[:-reach] << np.uint32(reach)
        found = found.copy()
        found[reach:] += moved
        reach *= 2
    return found


def chunk_ends(data: bytes) -> list[int]:
    """Where each chunk ends."""
    size = len(data)
    if size <= LEAST:
        return [size] if size else []
    hashed = rolling(data)
    loose = np.flatnonzero(hashed >> (_TOP - np.uint32(LOOSE_BITS)) == 0)
    strict = loose[hashed[loose] >> (_TOP - np.uint32(STRICT_BITS)) == 0]
    loose, strict = (loose + 1).tolist(), (strict + 1).tolist()  # an end lies behind its byte
    ends, start = [], 0
    while size - start > LEAST:
        usual, last = start + NORMAL, min(start + MOST, size)
        at = bisect_right(strict, start + LEAST - 1)
        if at < len(strict) and strict[at] <= min(usual, last):
            end = strict[at]
        else:
            at = bisect_right(loose, usual)
            end = loose[at] if at < len(loose) and loose[at] < last else last
        ends.append(end)
        start = end
    if start < size:
        ends.append(size)
    return ends


def fingerprint(data: bytes) -> np.ndarray:
    """A sorted number for each different chunk: 48 bits of its digest, then its length."""
    start, found, digest, low = 0, set(), xxhash.xxh64_intdigest, (1 << LENGTH_BITS) - 1
    for end in chunk_ends(data):
        found.add(digest(data[start:end], SEED) & ~low | (end - start))
        start = end
    return np.array(sorted(found), np.uint64)


def lengths(own: np.ndarray) -> int:
    return int((own & np.uint64((1 << LENGTH_BITS) - 1)).sum())


def containment(own: np.ndarray, other: np.ndarray) -> float:
    """The share of ``own``'s length whose chunks ``other`` has; an empty one lies in another
    empty one alone."""
    if not len(own):
        return 0.0 if len(other) else 1.0
    return lengths(np.intersect1d(own, other, assume_unique=True)) / lengths(own)


def written(own: np.ndarray) -> str:
    """16 hex digits for each chunk."""
    return own.astype(">u8").tobytes().hex()


def edited(text: str, next_text: str) -> str:
    """The second half of a text replaced by as much of the front of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + next_text[:half]


def _rank(identifier: int | None, hashed: int) -> tuple[bool, int, int]:
    """Order of rows: identifiers from the largest on, absent ones last; then the text's hash."""
    return identifier is None, -(identifier or 0), hashed


def _dealt(firsts: list[tuple[bool, int, int]]):
    """Rows with the range they fall in; the first of a range once more, for the end of the range
    before it.  A task hands on only the least text for each range that rows of one key begin."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, str] = {}
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            part, begins = [], []
            for at, key in enumerate(zip(ids, hashes, strict=True)):
                rank = _rank(*key)
                part.append(max(0, bisect_right(firsts, rank) - 1))
                if firsts[part[-1]] == rank:
                    text = batch.column(2)[at].as_py()
                    if part[-1] not in least or text < least[part[-1]]:
                        least[part[-1]] = text
                        begins.append(at)
            before = [(part[at] - 1) % len(firsts) for at in begins]
            taken = pa.array([*range(batch.num_rows), *begins], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part + before, pa.int32()), pa.array([False] * len(part) + [True] * len(before), pa.bool_()),
                    *[column.take(taken) for column in batch.columns],
                ],
                names=["part", "copy", "id", "hash", "text"],
            )

    return deal


PRINTS = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with the one behind it in its range.  A range is followed by the next one's
    first, which only ends it; of several such copies the first is the least."""
    part = held = None
    for batch in batches:
        rows = []
        columns = (batch.column(name).to_pylist() for name in ("part", "copy", "id"))
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for own, copy, identifier, raw in zip(*columns, texts, strict=True):
            text = raw.decode(errors="replace")
            prints = fingerprint(raw)
            if held and own == part:
                before, before_text, before_prints = held
                changed = edited(before_text, text).encode()
                after = fingerprint(changed)
                rows.append((
                    before, len(before_text), hashlib.sha256(changed).hexdigest(), written(before_prints), written(after),
                    containment(before_prints, after), containment(before_prints, prints),
                ))
            part, held = own, None if copy else (identifier, text, prints)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = list(zip(*rows, strict=True)) or [()] * len(types)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)],
            names=[field.split()[0] for field in PRINTS.split(", ")],
        )


def range_starts(keys: DataFrame, ranges: int) -> list[tuple[int | None, int]]:
    """The first key of each of some ranges of about the same size, in order; one row for each
    range comes to the driver.  ``keys`` has ``id`` and ``hash``."""
    order = [F.col("id").desc_nulls_last(), F.col("hash").asc()]
    parted = keys.repartitionByRange(ranges, *order).select(
        F.spark_partition_id().alias("part"), F.col("id").isNull().alias("absent"), (-F.coalesce("id", F.lit(0))).alias("down"),
        "id", "hash",
    )
    firsts = parted.groupBy("part").agg(F.min(F.struct("absent", "down", "hash", "id")).alias("first")).collect()
    found = {(row["first"]["id"], row["first"]["hash"]) for row in firsts}
    return sorted(found, key=lambda key: _rank(*key))


def chunk_prints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None
) -> DataFrame:
    """One row per input row: ``id``, ``n_chars``, the fingerprints of the text and of its edited
    text (its second half replaced by the front of the next document) in hex, the edited text's
    SHA-256, and how much of the text's fingerprint lies in the edited text's (``near_edited``)
    and in the next document's (``near_next``).

    The next document is the one with the next smaller identifier, after the last the first.
    Rows of one identifier, and rows without one, which come last, are ordered by their text's
    hash and then by the text; repeated rows follow one another.  Absent texts are empty; the
    fingerprint of an empty text is empty and lies wholly in another empty one.  A lone document
    is its own next.  Other columns play no part; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).select("id", F.xxhash64("text").alias("hash"), "text")
    ranges = ranges or max(1, spark.sparkContext.defaultParallelism, partitions_of(narrow))
    firsts = range_starts(narrow.select("id", "hash"), ranges)
    if not firsts:
        return spark.createDataFrame([], PRINTS)
    dealt = narrow.select("id", "hash", "text").mapInArrow(
        _dealt([_rank(*key) for key in firsts]), "part int, copy boolean, id long, hash long, text string"
    )
    placed = dealt.repartitionById(len(firsts), F.col("part"))
    order = ["part", "copy", F.col("id").desc_nulls_last(), "hash", "text"]
    return placed.sortWithinPartitions(*order).mapInArrow(_compare, PRINTS)
