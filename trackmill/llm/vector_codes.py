"""Vector codes by product quantisation, nearest entries found by LAESA pivots.

A vector of integers is cut into equal parts, and each part position has a codebook of its
own.  A few fixed pivots stand in each part position's space.  The distances of every part to
its pivots are worked out once and stored beside the part; each round only the few distances of
the new entries to the pivots are new.  For a part ``x``, an entry ``e`` and a pivot ``p`` the
triangle inequality gives ``|d(x, p) - d(e, p)| <= d(x, e)``, so the largest such difference
bounds the distance from below.  A part looks at its entries from the least bound on and works
out exact squared distances in integers; it stops when the least bound left exceeds the best
distance.  Ties go to the lower index, so entries whose bound equals the best are still seen.

Sums for the new entries are gathered inside tasks, then by part position and entry over all
tasks; codebooks are small (entries times dimensions) and the only thing that is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import small_batches
from trackmill.session import durable

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
PIVOTS = 6
# Vectors of an Arrow batch: the bounds of one part position take a few MB.
VECTORS = 4096
# Components beyond this would let a sum of squares pass 64 bits.
LARGEST = 1 << 26
# Bounds are held in 32-bit floats; this covers their rounding.
SLACK = 1e-6


def _rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lists of a column: where each starts, its length (-1 where it is null), all values."""
    column = column.cast(pa.list_(pa.float64()))
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)  # absent components as not a number
    length = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), -1)
    return offsets[:-1], length, values


def whole_vectors(column: pa.Array, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``dimensions`` finite components, and these rows' integers."""
    start, length, values = _rows_of(column)
    right = np.flatnonzero(length == dimensions)
    taken = values[start[right, None] + np.arange(dimensions)] if len(right) else np.zeros((0, dimensions))
    finite = np.isfinite(taken).all(1)
    scaled = np.floor(taken[finite] * scale)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise OverflowError(f"a component beyond {LARGEST / scale:.0f} would let a sum of squares pass 64 bits")
    return right[finite], scaled.astype(np.int64)


def pivots_of(entries: np.ndarray, pivots: int) -> np.ndarray:
    """``pivots`` entries of each part position, each as far as can be from those before it.

    ``entries`` is parts x entries x width."""
    chosen = []
    for own in entries:
        picked = [0]
        far = ((own - own[0]) ** 2).sum(1)
        while len(picked) < pivots:
            picked.append(int(far.argmax()))
            far = np.minimum(far, ((own - own[picked[-1]]) ** 2).sum(1))
        chosen.append(own[picked])
    return np.stack(chosen)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each point to each pivot of the same part position."""
    apart = points[:, None, :] - pivots[None, :, :]
    return np.sqrt((apart * apart).sum(-1)).astype(np.float32)


def nearest(
    points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of each point's nearest entry and the squared distance, exactly; and how many exact
    distances it took.  ``to_pivots`` and ``entry_pivots`` are distances to the same pivots."""
    n, seen = len(points), 0
    best, at = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
    bound = np.zeros((n, len(entries)), np.float32)
    for own, known in zip(to_pivots.T, entry_pivots.T, strict=True):
        np.maximum(bound, np.abs(own[:, None] - known[None, :]), out=bound)
    slack = SLACK * (to_pivots.max(1) + entry_pivots.max() + 1)
    open_ = np.arange(n)
    while len(open_):
        next_ = bound.argmin(1)
        # What has been seen has no bound any more; points with none left are done too.
        least = bound[np.arange(len(open_)), next_]
        hopeful = least <= np.sqrt(best[open_]) + slack[open_]
        hopeful &= np.isfinite(least)
        if not hopeful.all():
            open_, next_, bound = open_[hopeful], next_[hopeful], bound[hopeful]
        apart = points[open_] - entries[next_]
        square = (apart * apart).sum(1)
        seen += len(open_)
        closer = (square < best[open_]) | ((square == best[open_]) & (next_ < at[open_]))
        moved = open_[closer]
        best[moved], at[moved] = square[closer], next_[closer]
        bound[np.arange(len(open_)), next_] = np.inf
    return at, best, seen


def _prepare(dimensions: int, scale: int, pivots: list):
    places = np.array(pivots, np.int64)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, width = len(places), dimensions // len(places)
        for batch in batches:
            rows, found = whole_vectors(batch.column(2), dimensions, scale)
            cut = found.reshape(len(found), parts, width)
            far = np.stack([distances(cut[:, i], places[i]) for i in range(parts)], 1)
            kept = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(kept), batch.column(1).take(kept),
                    pa.array([row.tobytes() for row in found.astype("<i4")], pa.binary()),
                    pa.array([row.tobytes() for row in far], pa.binary()),
                ],
                names=["id", "label", "vector", "far"],
            )

    return prepare


def _decoded(batch: pa.RecordBatch, vector: str, far: str, shape: tuple[int, int, int]):
    """Parts (rows x parts x width) and their pivot distances (rows x parts x pivots)."""
    parts, width, pivots = shape
    points = np.frombuffer(b"".join(batch.column(vector).to_pylist()), "<i4").astype(np.int64)
    known = np.frombuffer(b"".join(batch.column(far).to_pylist()), np.float32)
    return points.reshape(-1, parts, width), known.reshape(-1, parts, pivots)


def _gather(shape: tuple[int, int, int], sent):
    """Per part position and entry, the sum and number of the parts nearest to it."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, entry_pivots = sent.value
        parts, many, width = entries.shape
        sums, counts = np.zeros((parts, many, width), np.int64), np.zeros((parts, many), np.int64)
        for batch in batches:
            points, known = _decoded(batch, "vector", "far", shape)
            for i in range(parts):
                at, _, _ = nearest(points[:, i], known[:, i], entries[i], entry_pivots[i])
                np.add.at(sums[i], at, points[:, i])
                counts[i] += np.bincount(at, minlength=many)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
                pa.array(sums[part, entry].tolist(), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    return gather


def _encode(shape: tuple[int, int, int], sent):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, entry_pivots = sent.value
        for batch in batches:
            points, known = _decoded(batch, "vector", "far", shape)
            error, codes = np.zeros(len(points), np.int64), np.zeros((len(points), shape[0]), np.uint8)
            for i in range(shape[0]):
                at, square, _ = nearest(points[:, i], known[:, i], entries[i], entry_pivots[i])
                codes[:, i] = at
                error += square
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("label"),
                    pa.array([row.tobytes().hex() for row in codes], pa.string()), pa.array(error),
                ],
                names=["id", "label", "code", "error"],
            )

    return encode


def first_entries(vectors: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray:
    """Entries a codebook starts with, parts x entries x width: the first kept vectors by
    identifier.  Only that many rows reach the driver.  The least vector by identifier whose
    length can be cut into parts sets the dimensions."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    order = [F.col("id").asc_nulls_last(), F.col("embedding").asc()]
    kept = vectors.where(F.col("embedding").isNotNull() & finite)
    fitting = kept.where((F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    first = fitting.orderBy(*order).limit(1).select(F.size("embedding").alias("n")).collect()
    if not first:
        return np.zeros((parts, 0, 1), np.int64)
    dimensions = first[0]["n"]
    rows = kept.where(F.size("embedding") == dimensions).orderBy(*order).limit(entries).select("embedding").toArrow()
    _, found = whole_vectors(rows.column(0).combine_chunks(), dimensions, scale)
    return np.ascontiguousarray(found.reshape(len(found), parts, -1).transpose(1, 0, 2))


def codebook_text(codebooks: np.ndarray) -> str:
    """All components in decimal by part position, entry and position within the part."""
    return ",".join(map(str, codebooks.ravel().tolist()))


def moved_entries(codebooks: np.ndarray, told: pa.Table) -> np.ndarray:
    """Each entry replaced by the floor of its parts' mean; unused entries stay."""
    found = codebooks.copy()
    for row in told.to_pylist():
        found[row["part"], row["entry"]] = [int(s) // row["n"] for s in row["sums"]]  # Python's // floors
    return found


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """One row per kept vector, ``id``, ``label``, ``code`` (two hex digits a part), ``error``
    and ``label_error``, and the final codebooks, parts x entries x width.

    Vectors that are null, hold a null or non-finite component, or differ in length from the first
    one by identifier that can be cut into equal parts are dropped.  Repeated rows are coded
    and counted again; the first entries come from the first rows by identifier (absent ones
    last), then by components.  With fewer vectors than entries a codebook has fewer; without any
    the result is empty.  Absent labels are one label.  Other columns play no part.  A component
    so large that sums of squares would pass 64 bits ends the run with an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits has 256 entries at most")
    spark = vectors.sparkSession
    narrow = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("embedding"),
    )
    codebooks = first_entries(narrow, parts, entries, scale)
    width, dimensions = codebooks.shape[2], parts * codebooks.shape[2]
    if not codebooks.shape[1]:
        none = narrow.limit(0).select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none.withColumn("label_error", F.col("error")), codebooks
    places, shape = pivots_of(codebooks, pivots), (parts, width, pivots)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", VECTORS)
    prepared = durable(narrow.mapInArrow(
        _prepare(dimensions, scale, places.tolist()), "id long, label string, vector binary, far binary"
    ))

    def told_of(codebooks: np.ndarray):
        far = np.stack([distances(codebooks[i], places[i]) for i in range(parts)])
        return spark.sparkContext.broadcast((codebooks, far))

    for _ in range(rounds):
        gathered = prepared.mapInArrow(_gather(shape, told_of(codebooks)), "part int, entry int, n long, sums array<long>")
        exact = [F.sum(F.element_at("sums", i + 1).cast("decimal(38,0)")) for i in range(width)]
        told = gathered.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*exact).alias("sums"))
        codebooks = moved_entries(codebooks, told.toArrow())
    coded = durable(prepared.mapInArrow(_encode(shape, told_of(codebooks)), "id long, label string, code string, error long"))
    small_batches(spark)
    # Written, so that the join with it can be split where very many vectors share a label.
    summed = durable(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")))
    joined = coded.join(summed, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("id", "label", "code", "error", "label_error"), codebooks


def codebook_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(codebook_text(codebooks).encode()).hexdigest()
