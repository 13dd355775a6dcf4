"""SimHash near-duplicates: fingerprints, bit-sliced comparison, components.

A text's fingerprint has the majority bit of its shingles' XXH64 hashes at each place.  Only
different fingerprints are compared, so exact copies cost nothing.  Fingerprints within
``radius`` bits agree in two of ``radius + 2`` blocks of bits; each pair of blocks is a key, and
fingerprints meet under equal keys.  Those that meet are compared in bit-sliced form: 64 of
them stand in the lanes of a machine word, one word per bit plane, and one query's distance
to all 64 is counted at once by carry-save counters; a word is given up as soon as all its
lanes are beyond the radius.  A key with more fingerprints than one task should compare is
cut into blocks, and every two blocks meet in a cell of their own.

Of the links in a cell only a spanning forest leaves it, so groups of many near copies do not
multiply into pairs; nothing is dropped, since links are closed into components anyway.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import small_batches
from trackmill.llm.components import components
from trackmill.session import durable

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
# Fingerprints of one key that are compared in one cell.
CELL_ROWS = 4096
# Pairs of a query and a word of lanes that are compared at a time.
WORK_ITEMS = 1 << 17


def fingerprint(text: bytes, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Majority bits of the shingles' hashes as a signed 64-bit number; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z alone, and blank as \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    stops = ends[min(width, len(words)) - 1:]
    hashed, digest = np.empty(n, np.uint64), xxhash.xxh64_intdigest
    hashed[:] = [digest(joined[i:j], seed) for i, j in zip(starts[:n].tolist(), stops.tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        some = hashed[at:at + (1 << 14)]
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def text_hash(text: Column) -> Column:
    """Tells the texts of one identifier apart; an absent text is an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS
) -> DataFrame:
    """``id``, ``fingerprint`` and ``text_hash`` of every row, written once."""
    small_batches(docs.sparkSession)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            marks = pa.array([fingerprint(text or b"", width) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), marks, batch.column(2)], names=["id", "fingerprint", "text_hash"]
            )

    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), text_hash(text).alias("text_hash"))
    return durable(narrow.mapInArrow(mark, "id long, fingerprint long, text_hash long"))


def bit_planes(prints: np.ndarray, lanes: np.ndarray, n_words: int) -> np.ndarray:
    """64 planes of ``n_words`` words; fingerprint ``i`` stands in lane ``lanes[i]``."""
    planes = np.empty((64, n_words), np.uint64)
    bits = np.zeros(n_words * 64, np.uint8)
    for plane in range(64):
        bits[lanes] = (prints >> np.uint64(plane)) & np.uint64(1)
        planes[plane] = np.packbits(bits, bitorder="little").view(np.uint64)
    return planes


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is above the radius."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            above |= equal & counters[k]
            equal = equal & ~counters[k]
    return above


def near_lanes(
    planes: np.ndarray, queries: np.ndarray, words: np.ndarray, alive: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of a query fingerprint and a word of lanes, the lanes of ``alive`` within the
    radius: indices of the pairs that have any, and their lanes as bits."""
    at = np.arange(len(queries))
    counters = [np.zeros(len(at), np.uint64) for _ in range(max(1, radius.bit_length()))]
    for plane in range(64):
        mine = np.uint64(0) - ((queries >> np.uint64(plane)) & np.uint64(1))
        carry = planes[plane][words] ^ mine
        for k, counter in enumerate(counters):
            counters[k], carry = counter ^ carry, counter & carry
        alive = alive & ~(carry | _beyond(counters, radius))
        if plane % 4 == 3:
            left = alive != 0
            if not left.all():  # words with all lanes beyond the radius are given up
                at, queries, words, alive = at[left], queries[left], words[left], alive[left]
                counters = [counter[left] for counter in counters]
                if not len(at):
                    break
    return at, alive


def _join(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give linked rows the least label of their set, in place."""
    while len(left):
        a, b = labels[left], labels[right]
        open_ = a != b
        if not open_.any():
            return
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels[:] = jumped


def linked_rows(cells: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """For rows sorted by cell, the first row of the linked set within the cell of each."""
    n = len(prints)
    first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    sizes = np.diff(np.concatenate((first, [n])))
    n_words = (sizes + 63) // 64
    word_ends = np.cumsum(n_words)
    word_starts = word_ends - n_words
    cell = np.repeat(np.arange(len(first)), sizes)
    lanes = word_starts[cell] * 64 + np.arange(n) - first[cell]
    planes = bit_planes(prints, lanes, int(word_ends[-1]))
    row_at = np.zeros(int(word_ends[-1]) * 64, np.int64)
    row_at[lanes] = np.arange(n)
    present = np.zeros(len(row_at), np.uint8)
    present[lanes] = 1
    valid = np.packbits(present, bitorder="little").view(np.uint64)
    own_word, own_lane = lanes // 64, (lanes % 64).astype(np.uint64)
    work = np.where(sizes[cell] > 1, word_ends[cell] - own_word, 0)
    labels = np.arange(n)
    done = np.cumsum(work)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + WORK_ITEMS, "right")))
        rows = np.repeat(np.arange(at, stop), work[at:stop])
        if len(rows):
            begin = np.cumsum(work[at:stop]) - work[at:stop]
            words = own_word[rows] + np.arange(len(rows)) - np.repeat(begin, work[at:stop])
            later = ~((np.uint64(2) << own_lane[rows]) - np.uint64(1))
            alive = valid[words] & np.where(words == own_word[rows], later, ~np.uint64(0))
            pairs, near = near_lanes(planes, prints[rows], words, alive, radius)
            if len(pairs):
                bits = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                item, lane = np.nonzero(bits)
                _join(labels, rows[pairs][item], row_at[words[pairs][item] * 64 + lane])
        at = stop
    return labels


def _compare(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def links(cells: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            labels = linked_rows(cells, prints, radius)
            moved = np.flatnonzero(labels != np.arange(len(labels)))
            signed = prints.view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(signed[moved]), pa.array(signed[labels[moved]])], names=["a", "b"]
            )

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
            size += batch.num_rows
            if size >= 1 << 15:
                cells, prints = (np.concatenate(part) for part in zip(*held, strict=True))
                # The last cell may go on in the next batch.
                whole = int(np.searchsorted(cells, cells[-1]))
                if whole:
                    yield links(cells[:whole], prints[:whole])
                held, size = [(cells[whole:], prints[whole:])], len(cells) - whole
        if size:
            cells, prints = (np.concatenate(part) for part in zip(*held, strict=True))
            yield links(cells, prints)

    return compare


def block_keys(radius: int):
    """Keys under which fingerprints within the radius meet, as one array column."""
    blocks = radius + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit((1 << high - low) - 1))
        for low, high in zip(cuts, cuts[1:], strict=False)
    ]
    return F.array(*[
        F.struct(F.lit(i).alias("pair"), parts[a].alias("left"), parts[b].alias("right"))
        for i, (a, b) in enumerate(combinations(range(blocks), 2))
    ])


def near_links(prints: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links ``a``, ``b`` between different fingerprints of a column ``fingerprint``, enough to
    connect all that are within the radius of one another."""
    keyed = prints.select("fingerprint", F.explode(block_keys(radius)).alias("key"))
    # Written, so that the join with it can be split where a key is crowded.
    crowds = durable(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    blocks = F.ceil(F.col("n") / cell_rows).cast("int")
    own = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (
        keyed.join(crowds, "key").withColumn("blocks", blocks).withColumn("own", own)
        .select("fingerprint", "key", "own", other.alias("other"))
        .select("fingerprint", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"))
    )
    # Cells are named by a hash; two cells of one name are compared together, which only
    # finds links that hold anyway.
    dealt = met.select("cell", "fingerprint").repartition("cell").sortWithinPartitions("cell", "fingerprint")
    return dealt.mapInArrow(_compare(radius), "a long, b long")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
    radius: int = RADIUS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """One row per input row: ``id``, ``fingerprint`` (signed), ``text_hash``, ``group`` (least fingerprint
    that links lead to) and ``component_id``, the smallest identifier of the group.

    Absent and empty texts and texts of blanks have fingerprint 0, which links like any other;
    texts of fewer words than a shingle are one shingle.  Absent identifiers never name a
    component that has another; repeated rows are repeated.
    """
    rows = fingerprints(docs, id_col, text_col, width)
    nodes = durable(rows.groupBy("fingerprint").agg(F.min("id").alias("least_id")))
    joined = components(near_links(nodes, radius, cell_rows))
    grouped = nodes.join(joined, nodes["fingerprint"] == joined["node"], "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("group")
    )
    named = grouped.groupBy("group").agg(F.min("least_id").alias("component_id"))
    # Written, so that the join with it can be split where very many rows are copies.
    told = durable(grouped.join(named, "group").select("fingerprint", "group", "component_id"))
    return rows.join(told, "fingerprint").select("id", "fingerprint", "text_hash", "group", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents with all their columns, whatever these are called, one of each group: that with
    the smallest identifier, absent ones last, and of rows that share it that of the smallest text
    hash.  Of rows that repeat both identifier and text one stays.  An empty table gives no rows."""
    first = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "text_hash"))
    stays = near_groups(docs, id_col, text_col, **settings).groupBy("group").agg(first.alias("first"))
    # Written, so that the join with it can be split.
    stays = durable(stays.select(F.col("first.id").alias("_id"), F.col("first.text_hash").alias("_hash")))
    named = docs.select(
        F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_own"),
        text_hash(F.col(text_col).cast("string")).alias("_text"),
    )
    met = named.join(stays, (F.col("_own").eqNullSafe(F.col("_id"))) & (F.col("_text") == F.col("_hash")))
    return met.dropDuplicates(["_own", "_text"]).select("_row.*")
