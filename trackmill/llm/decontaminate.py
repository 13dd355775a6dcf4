"""Benchmark decontamination by pigeonhole edit matching.

A test item of ``m`` words may occur with up to ``k = floor(m * error_share)`` words
inserted, deleted or replaced.  Cut into ``k + 1`` pieces, at least one piece of it must
then occur unchanged.  One Aho-Corasick automaton finds all pieces of all items in a pass
over a document's words; around every hit, Myers' bit-parallel algorithm, one bit per word
of the item, finds the places that are within ``k`` edits of the whole item.

Items of few words are looked for as they are, without edits.  Items in scripts that write no
blanks between words are matched, and their edits counted, by characters.

Documents never move: each is compared in the task that reads it.  Items come to the tasks
in blocks of bounded size, and a further block is a further pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import small_batches, worker_state
from trackmill.llm.words import WordCounter, word_stream

# A fifth of an item's words may differ: similarity 0.8 or more.
ERROR_SHARE = 0.2
# Items shorter than this say too little to be told with words changed: they must occur exactly.
LEAST_WORDS = 8
# Characters of items that go to the tasks at once.
BLOCK_CHARS = 4_000_000

# Letters of scripts without blanks between words: Chinese, Japanese, Thai, Lao, Burmese, Khmer.
UNSPACED = re.compile(
    "[\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f"
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\U00020000-\U0003ffff]"
)
# Blanks and marks beyond ASCII, full-width ones among them.
WIDE_MARKS = re.compile("[\u2000-\u206f\u3000-\u3004\u3008-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")

Item = tuple[int, list[str]]
LEAKS = "id long, item_id long, first_word long, last_word long, distance int, n_item_words int"


def pieces_of(words: list[str], budget: int) -> list[tuple[int, list[str]]]:
    """``budget + 1`` pieces of nearly equal length, with their offsets."""
    cuts = [len(words) * i // (budget + 1) for i in range(budget + 2)]
    return [(start, words[start:end]) for start, end in zip(cuts, cuts[1:], strict=False)]


class Masks:
    """An item's words as bit masks, for the item and for its reverse."""

    def __init__(self, words: list[str]) -> None:
        self.m = len(words)
        self.forward = self._masks(words)
        self.backward = self._masks(words[::-1])

    @staticmethod
    def _masks(words: list[str]) -> dict[str, int]:
        found: dict[str, int] = {}
        for i, word in enumerate(words):
            found[word] = found.get(word, 0) | 1 << i
        return found


def bit_parallel(masks: dict[str, int], m: int, words: list[str], anchored: bool) -> Iterator[int]:
    """After each word, the least edits that turn the pattern into words that end there:
    into all words so far when ``anchored``, otherwise into any run of them."""
    ones = (1 << m) - 1
    top = 1 << (m - 1)
    plus, minus, score = ones, 0, m
    for word in words:
        equal = masks.get(word, 0)
        vertical = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (ones & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | anchored) & ones
        down = (down << 1) & ones
        plus = down | (ones & ~(vertical | up))
        minus = up & vertical
        yield score


def occurrences(masks: Masks, budget: int, words: list[str]) -> Iterator[tuple[int, int, int]]:
    """Places ``(first, last, distance)`` of the item in ``words``, one for each stretch
    of ends within the budget: the end with the fewest edits, the last of equals."""
    best: tuple[int, int] | None = None
    ends: list[tuple[int, int]] = []
    for at, score in enumerate(bit_parallel(masks.forward, masks.m, words, False)):
        if score <= budget:
            if best is None or score <= best[0]:
                best = (score, at)
        elif best is not None:
            ends.append(best)
            best = None
    if best is not None:
        ends.append(best)
    for score, end in ends:
        # Backwards from the end, the place where the whole item is used up.
        back = words[max(0, end + 1 - masks.m - budget):end + 1][::-1]
        lengths = [
            n for n, edits in enumerate(bit_parallel(masks.backward, masks.m, back, True), 1) if edits == score
        ]
        yield end + 1 - (lengths[0] if lengths else len(back)), end, score


def words_in(stream: str) -> list[str]:
    """Words of a stream, cut at its blanks alone: blanks beyond ASCII are within words."""
    return stream[1:-1].split(" ") if len(stream) > 1 else []


def characters_of(word: str) -> list[str]:
    """A word of the stream cut at wide marks and into the letters of unspaced scripts."""
    return UNSPACED.sub(r" \g<0> ", WIDE_MARKS.sub(" ", word)).split()


def is_unspaced(words: list[str]) -> bool:
    """Whether most of an item is in unspaced scripts."""
    cut = [part for word in words for part in characters_of(word)]
    return 2 * sum(bool(UNSPACED.match(part)) for part in cut) > len(cut)


class Automaton:
    """All pieces of some items in one automaton."""

    def __init__(self, items: list[Item], error_share: float, least_words: int) -> None:
        self.items: list[tuple[int, int, int, Masks]] = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, words in items:
            budget = int(len(words) * error_share) if len(words) >= least_words else 0
            for offset, piece in pieces_of(words, budget):
                pieces.setdefault(" " + " ".join(piece) + " ", []).append((len(self.items), offset))
            self.items.append((item_id, len(words), budget, Masks(words)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()

    def leaks(self, stream: str) -> list[tuple[int, int, int, int, int]]:
        """Every place of every item: item, first and last word, edits, words of the item."""
        if not self.items:
            return []
        counter = WordCounter(stream)
        windows: dict[int, list[list[int]]] = {}
        for end, (length, places) in self.automaton.iter(stream):
            at = counter.index(end - length + 1)
            for item, offset in places:
                _, m, budget, _ = self.items[item]
                start, stop = max(0, at - offset - budget), at - offset + m + budget
                own = windows.setdefault(item, [])
                own.append([start, stop])
        if not windows:
            return []
        words = words_in(stream)
        found = []
        for item, own in windows.items():
            item_id, m, budget, masks = self.items[item]
            own.sort()
            merged = [own[0]]
            for start, stop in own[1:]:
                if start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([start, stop])
            for start, stop in merged:
                for first, last, edits in occurrences(masks, budget, words[start:stop]):
                    found.append((item_id, start + first, start + last, edits, m))
        return found


class Matcher:
    """All items of a block: by words, or by characters in unspaced scripts."""

    def __init__(self, items: list[Item], error_share: float, least_words: int = LEAST_WORDS) -> None:
        spaced = [(number, words) for number, words in items if not is_unspaced(words)]
        unspaced = [
            (number, [part for word in words for part in characters_of(word)])
            for number, words in items if is_unspaced(words)
        ]
        self.words = Automaton(spaced, error_share, least_words)
        self.characters = Automaton(unspaced, error_share, least_words)

    def leaks(self, text: bytes) -> list[tuple[int, int, int, int, int]]:
        """Every place of every item: item, first and last word, edits, words of the item; of
        items in unspaced scripts, edits and length are in characters."""
        _, stream = word_stream(text)
        found = self.words.leaks(stream)
        if self.characters.items and UNSPACED.search(stream):
            parts = [(part, at) for at, word in enumerate(words_in(stream)) for part in characters_of(word)]
            fine = " " + "".join(part + " " for part, _ in parts)
            for item_id, first, last, edits, m in self.characters.leaks(fine):
                found.append((item_id, parts[first][1], parts[last][1], edits, m))
        return found


def item_blocks(items: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[Item]]:
    """Items as word lists, in blocks; absent and repeated ones and those without words are left out."""
    block: list[Item] = []
    size = 0
    rows = items.select(F.col(item_col).cast("long"), F.col(text_col).cast("string")).distinct()
    for item_id, text in rows.toLocalIterator():
        n, stream = word_stream((text or "").encode())
        if item_id is None or not n:
            continue
        block.append((item_id, words_in(stream)))
        size += len(stream)
        if size >= block_chars:
            yield sorted(block)
            block, size = [], 0
    if block:
        yield sorted(block)


def _matcher(sent, error_share: float, least_words: int) -> Matcher:
    return worker_state(
        f"matcher_{sent.id}_{error_share}_{least_words}", lambda: Matcher(sent.value, error_share, least_words)
    )


class Sent:
    """A block as the tasks get it: broadcast, with a number that tells blocks apart."""

    def __init__(self, spark, block: list[Item]) -> None:
        self.broadcast = spark.sparkContext.broadcast(block)
        self.id = f"{spark.sparkContext.applicationId}_{id(self.broadcast)}_{hash(str(block[:3]))}_{len(block)}"

    @property
    def value(self) -> list[Item]:
        return self.broadcast.value


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
    error_share: float = ERROR_SHARE, least_words: int = LEAST_WORDS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every place where a document holds a test item within its error budget: ``id``,
    ``item_id``, ``first_word``, ``last_word`` (from 0), ``distance`` and ``n_item_words``.

    Absent and empty texts hold nothing; repeated documents are reported again, repeated
    items once; items below ``least_words`` words must occur exactly; those without words or
    an identifier are not looked for.  In unspaced scripts ``least_words``, ``distance`` and
    ``n_item_words`` count characters.  Without items or documents there are no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = spark.createDataFrame([], LEAKS)
    for block in item_blocks(items, item_col, item_text_col, block_chars):
        sent = Sent(spark, block)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(sent, error_share, least_words)
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
                rows = [(i, *leak) for i, text in zip(ids, texts, strict=True) for leak in matcher.leaks(text or b"")]
                if rows:
                    kinds = [pa.int64()] * 4 + [pa.int32()] * 2
                    arrays = [pa.array(list(v), kind) for v, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                    names = ["id", "item_id", "first_word", "last_word", "distance", "n_item_words"]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

        found = found.union(narrow.mapInArrow(scan, LEAKS))
    return found


def without_leaks(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", error_share: float = ERROR_SHARE, least_words: int = LEAST_WORDS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents, with all their columns, that hold no test item."""
    spark, kept = docs.sparkSession, docs
    small_batches(spark)
    for block in item_blocks(items, item_col, item_text_col, block_chars):
        sent = Sent(spark, block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(sent, error_share, least_words)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
                yield batch.filter(pa.array([not matcher.leaks(text or b"") for text in texts], pa.bool_()))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
