"""Phrases whose words keep company, counted in FM-indexes of the words.

Texts are dealt into shards of one language each.  A shard's words get numbers, its pieces stand
one after another with a mark between them, and its index is the Burrows-Wheeler transform of
that sequence, sorted by as many words as a phrase may have: for every place, in the order of
what follows it, the word before.  From it come ``C``, where the rows of each word begin, and
``psi``, the row of the place one further on (the inverse of the backward step).

A phrase is an interval of rows.  Its left extensions are the words of the transform within the
interval, each again an interval that ``psi`` maps back into that of the phrase; its right
extensions are the intervals inside its own.  So one index extends an interval to both sides:
a phrase of ``d`` words lies inside the interval of its first ``d - 1`` words and maps into
that of its last ``d - 1``.  Lengths are enumerated one after another, all intervals of a shard
at once; an interval's size is its count, and counts are summed across shards.

A phrase can be frequent only where both its shorter ends are.  After each length the frequent
phrases of all shards set bits of a filter of fixed size, which the next length is extended
by; a bit set by another phrase costs a few counts that the sum then rejects, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmill.llm.common import small_batches
from trackmill.session import durable

MOST_WORDS = 3
LEAST_COUNT = 10
# A phrase goes if a longer one has at least this share of its places, in percent.
HELD_PERCENT = 50
TOP = 2000
SCORE = 1_000_000
ABSENT = "und"

# Words and marks of a shard, about; of all shards that a task has open at once.
SHARD_WORDS = 1 << 20
OPEN_WORDS = 4 << 20
# Rows of counts handed on at once, and shards read at once.
COUNTS = 100_000
SHARDS = 2
FILTER_BITS = 1 << 27
SEED = 42
# Ranks of a language are taken in so many parts first.
PARTS = 64

#: What separates pieces, as bytes; the mark stands for each of them.
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
MARK = b"."
_PIECES = bytes(0x0A if b in SEPARATORS else b for b in range(256))


def marked_words(text: bytes) -> list[bytes]:
    """The words of a text in lower case (``A``-``Z``), a mark between and behind its pieces."""
    words = text.lower().translate(_PIECES).replace(b"\n", b" . ").split()  # left are \x20 and \x09
    words.append(MARK)
    return words


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def transform(ids: np.ndarray, words: int, depth: int) -> np.ndarray:
    """The Burrows-Wheeler transform of a circular sequence, sorted by ``depth`` ids."""
    bits = max(1, int(words - 1).bit_length())
    if bits * depth <= 63:
        key = ids.astype(np.int64)
        for step in range(1, depth):
            key = (key << bits) | np.roll(ids, -step)
        order = np.argsort(key)
    else:
        order = np.lexsort([np.roll(ids, -step) for step in reversed(range(depth))])
    return np.roll(ids, 1)[order]


class Intervals:
    """The intervals of a shard's index, one length of phrases after another.

    ``at`` has each row's interval, ``starts`` each interval's first row and ``sizes`` its
    count; intervals with a mark among their words have none."""

    def __init__(self, bwt: np.ndarray, words: int) -> None:
        counts = np.bincount(bwt, minlength=words)
        self.first = np.repeat(np.arange(words, dtype=np.int32), counts)  # by C
        self.psi = np.argsort(bwt, kind="stable").astype(np.int32)
        self.length = 1
        self.reach = np.arange(len(bwt), dtype=np.int32)  # the row of the phrase's last word
        self.open = self.first != 0
        self.edge = np.empty(len(bwt), bool)
        self.edge[:1] = True
        self.edge[1:] = self.first[1:] != self.first[:-1]
        self._count()

    def _count(self) -> None:
        self.at = np.cumsum(self.edge) - 1
        rows = np.flatnonzero(self.edge)
        sizes = np.diff(np.append(rows, len(self.edge)))
        self.number = len(rows)
        whole = self.open[rows]
        self.starts, self.sizes = rows[whole], sizes[whole]

    def extend(self, kept: np.ndarray | None = None) -> None:
        """Phrases of one word more.  ``kept`` says by interval which shorter phrases still
        count; a phrase needs both its front, inside which it lies, and its back, into which
        ``psi`` maps it."""
        if kept is not None:
            alive = kept[self.at]
            self.open &= alive & alive[self.psi]
        self.reach = self.psi[self.reach]
        last = self.first[self.reach]
        self.open &= last != 0
        self.edge[1:] |= last[1:] != last[:-1]
        self.length += 1
        self._count()

    def words(self, rows: np.ndarray) -> list[np.ndarray]:
        """The words of the phrases that the rows begin."""
        found = []
        for _ in range(self.length):
            found.append(self.first[rows])
            rows = self.psi[rows]
        return found


def _turned(hashed, by: int):
    return (hashed << np.uint64(by)) | (hashed >> np.uint64(64 - by))


def filter_places(hashes: list[np.ndarray], bits: int) -> np.ndarray:
    """A phrase's bit, from the hashes of its words."""
    mixed = np.zeros(len(hashes[0]), np.uint64)
    for hashed in hashes:
        mixed = _turned(mixed, 23) ^ hashed
    return (mixed & np.uint64(bits - 1)).astype(np.int64)


def filter_place(phrase: Column, words: int, bits: int) -> Column:
    """``filter_places`` of a column of phrases."""
    mixed = F.lit(0).cast("long")
    parts = F.split(phrase, " ")
    for i in range(words):
        turned = F.shiftleft(mixed, 23).bitwiseOR(F.shiftrightunsigned(mixed, 41))
        mixed = turned.bitwiseXOR(F.xxhash64(parts[i]))
    return mixed.bitwiseAND(F.lit(bits - 1))


INDEX = "lang string, words array<string>, bwt binary, n long"


def _index(shard_words: int, open_words: int, depth: int):
    """Shards of the texts: their words by number, the mark first, and their index."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Numbers, list[np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def shard(lang: str) -> pa.RecordBatch:
            numbers, parts = held.pop(lang)
            del sizes[lang]
            ids = np.concatenate(parts)
            bwt = transform(ids, len(numbers), depth).astype("<i4")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]), pa.array([[word.decode(errors="replace") for word in numbers]], pa.list_(pa.string())),
                    pa.array([bwt.tobytes()], pa.binary()), pa.array([int((ids != 0).sum())], pa.int64()),
                ],
                names=["lang", "words", "bwt", "n"],
            )

        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for lang, text in zip(*columns, strict=True):
                if lang not in held:
                    held[lang], sizes[lang] = (Numbers({MARK: 0}), []), 0
                numbers, parts = held[lang]
                words = marked_words(text or b"")
                parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                sizes[lang] += len(words)
                if sizes[lang] >= shard_words:
                    yield shard(lang)
            while sum(sizes.values()) > open_words:
                yield shard(max(sizes, key=sizes.get))
        for lang in list(held):
            yield shard(lang)

    return index


COUNTED = "lang string, size int, phrase string, n long"


def _counted(size: int, bits: int, sent=None):
    """Phrases of the shards with their counts: of one and of two words, or of ``size`` words
    where the filter has both their ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column(1)[i].values.cast(pa.string())
                bwt = np.frombuffer(batch.column(2)[i].as_py(), "<i4")
                found, lang = Intervals(bwt, len(words)), batch.column(0)[i].as_py()
                if size == 2:
                    yield from told(lang, words, found)
                    found.extend()
                else:
                    known = np.frombuffer(sent.value, np.uint8)
                    hashes = np.array([xxhash.xxh64_intdigest(word, SEED) for word in words.to_pylist()], np.uint64)
                    found.extend()
                    for _ in range(2, size):
                        # Fronts of one length are all that the filter has to hold.
                        if found.length == size - 1:
                            place = filter_places([hashes[own] for own in found.words(found.starts)], bits)
                            kept = np.zeros(found.number, bool)
                            kept[found.at[found.starts]] = known[place >> 3] >> (place & 7).astype(np.uint8) & 1
                            found.extend(kept)
                        else:
                            found.extend()
                yield from told(lang, words, found)

    def told(lang: str, words: pa.Array, found: Intervals) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(found.starts), COUNTS):
            own = [words.take(pa.array(ids)) for ids in found.words(found.starts[at:at + COUNTS])]
            n = len(own[0])
            phrase = pc.binary_join_element_wise(*own, " ") if len(own) > 1 else own[0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()), pa.array(np.full(n, found.length, np.int32)), phrase,
                    pa.array(found.sizes[at:at + COUNTS].astype(np.int64)),
                ],
                names=["lang", "size", "phrase", "n"],
            )

    return count


def filter_of(phrases: DataFrame, size: int, bits: int) -> bytes:
    """A bit for each phrase; the filter's words are what reaches the driver, whatever there is."""
    place = phrases.select(filter_place(F.col("phrase"), size, bits).alias("place"))
    spark = phrases.sparkSession
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(31)).cast("int"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", COUNTS)
    rows = place.groupBy(F.shiftrightunsigned("place", 5).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    small_batches(spark)
    found = np.zeros(bits // 32, "<u4")
    found[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return found.tobytes()


def frequent_phrases(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most_words: int = MOST_WORDS,
    least_count: int = LEAST_COUNT, shard_words: int = SHARD_WORDS, open_words: int = OPEN_WORDS,
    filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``size``, ``phrase`` and count ``a`` of all phrases of up to ``most_words`` words
    with ``least_count`` places; and ``lang`` with the number ``n`` of its words."""
    if most_words < 2 or filter_bits & (filter_bits - 1) or filter_bits < 32:
        raise ValueError("phrases have two words or more, filters a power of two of bits")
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(ABSENT)).alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    shards = durable(narrow.mapInArrow(_index(shard_words, open_words, most_words), INDEX))
    found, sent = None, None
    for size in range(2, most_words + 1):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", SHARDS)
        counted = shards.mapInArrow(_counted(size, filter_bits, sent), COUNTED)
        summed = counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("a"))
        frequent = durable(summed.where(F.col("a") >= least_count))
        found = frequent if found is None else found.unionByName(frequent)
        if size < most_words:
            ends = filter_of(frequent.where(F.col("size") == size), size, filter_bits)
            sent = spark.sparkContext.broadcast(ends)
    small_batches(spark)
    return found, durable(shards.groupBy("lang").agg(F.sum("n").alias("n")))


def _joined(words: Column, first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most_words: int = MOST_WORDS,
    least_count: int = LEAST_COUNT, held_percent: int = HELD_PERCENT, top: int = TOP, **shards: int,
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank`` from 1, ``phrase``, its count ``a``,
    the counts ``l`` and ``r`` of the two parts of its lowest-scoring cut, the number ``n`` of the
    language's words, and ``score``, 1,000,000 a a / (l r) rounded down.

    Texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and
    tabs; phrases lie within pieces and overlapping places all count.  A phrase goes if
    a longer frequent one that holds its words has half of its places or more.  Equal scores are
    ranked by the count, then by the phrase; of cuts with equal scores the first counts.
    Absent languages are ``und``, absent texts empty; repeated rows count again, and other
    columns play no part.  An empty table, or one without frequent phrases, gives no rows.
    """
    phrases, totals = frequent_phrases(docs, lang_col, text_col, most_words, least_count, **shards)
    words = F.split("phrase", " ")
    counted = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("count"))
    candidates = phrases.where("size > 1")
    # A phrase's shorter parts are frequent too, so no cut is lost in these joins, whose other
    # side is written and can be split where a word begins or ends very many phrases.
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "size", "phrase", "a", "k", _joined(words, F.lit(1), F.col("k")).alias("head"),
        _joined(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    heads = counted.select("lang", F.col("part").alias("head"), F.col("count").alias("l"))
    tails = counted.select("lang", F.col("part").alias("tail"), F.col("count").alias("r"))

    def wide(column: Column) -> Column:
        return column.cast("decimal(19,0)")

    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumns({
        "above": wide(F.col("a")) * wide(F.col("a")) * F.lit(SCORE).cast("decimal(7,0)"),
        "below": wide(F.col("l")) * wide(F.col("r")),
    })
    lowest = scored.groupBy("lang", "size", "phrase", "a").agg(
        F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut")
    )
    # It is enough to look one word further: what a still longer phrase holds, the one between does.
    longer = candidates.where("size > 2")
    ends = [
        longer.select("lang", _joined(words, F.lit(start), F.col("size") - 1).alias("phrase"), F.col("a").alias("outer"))
        for start in (1, 2)
    ]
    outer = ends[0].union(ends[1]).groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    free = lowest.join(outer, ["lang", "phrase"], "left").where(
        F.col("outer").isNull() | (wide(F.col("outer")) * 100 < wide(F.col("a")) * held_percent)
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The first of every part of a language, then of these, so that no task ranks a whole language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = free.withColumn("part", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
    few = first.where(F.col("rank") <= top).drop("part", "rank")
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
