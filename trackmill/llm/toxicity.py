"""Toxicity by class-conditional Kneser-Ney models.

Words are sequences of characters.  For toxic and for ordinary text a Kneser-Ney model of
order ``ORDER`` gives each character given the ones before it in its word; both back off to
one shared model of the lower orders, whose counts are how many different characters stand
before an expression in either class.  An expression that a class has rarely shown is thus
judged alike by both, and a difference of the two log-likelihoods means evidence.

A document is judged by that difference in three length-normalised forms: per word of the
whole text, per word of its most toxic stretch, and of its most toxic word.  A logistic
regression turns them into a score; it is fitted on rows whose models have not seen them.

The models learn from a bounded sample of labelled rows, ``TRAIN_ROWS`` of each class at most
in expectation, drawn by a hash of the identifier; their size does not grow with the corpus.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import small_batches, worker_state
from trackmill.llm.words import WORD_BYTES
from trackmill.session import durable

ORDER = 6
DISCOUNT = 0.75
STRETCH = 8
TRAIN_ROWS = 20_000
FOLDS = 5
HELD_OUT = 0
# Words and their evidence that a worker keeps; with more it starts anew.
KEPT = 400_000
RIDGE = 0.1
FEATURES = 3
#: Odd factors of an expression's characters by their distance from its last.  Two of the expressions
#: of a model have one number with a chance of about their square over 2 ** 64.
FACTORS = np.random.default_rng(11).integers(0, 1 << 64, ORDER, np.uint64) | np.uint64(1)


def words_of(text: bytes) -> list[str]:
    return text.translate(WORD_BYTES).decode().split()


def grams(word: str) -> list[str]:
    """Every character of a bordered word with up to ``ORDER - 1`` before it."""
    bordered = "^" + word + "$"
    return [bordered[max(0, i - ORDER + 1):i + 1] for i in range(1, len(bordered))]


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of some texts in turn, from 1 on, and the number of each text's."""
    texts = pa.concat_arrays([texts.cast(pa.string())])  # its offsets begin at 0
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    raw = texts.buffers()[2]
    joined = raw.to_pybytes()[offsets[0]:offsets[-1]] if raw is not None else b""
    points = np.frombuffer(joined.decode().encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    return points, pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def windows(points: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """A number for the last ``width`` code points up to each place of its text, or as many as there
    are: the sum of the points times a factor by their distance."""
    found = np.zeros(len(points), np.uint64)
    for back in range(width):
        there = place >= back
        found[there] += points[np.flatnonzero(there) - back] * FACTORS[back]
    return found


class Grams(NamedTuple):
    """Different expressions as rows of code points, the last in the last column and 0 where there is
    none; their lengths; and a number for each by which it is found."""

    points: np.ndarray
    length: np.ndarray
    key: np.ndarray

    def taken(self, rows: np.ndarray) -> Grams:
        return Grams(self.points[rows], self.length[rows], self.key[rows])

    def contexts(self) -> np.ndarray:
        """Numbers of the expressions without their last character."""
        return (self.points[:, :-1] * FACTORS[ORDER - 2::-1]).sum(1, dtype=np.uint64)

    def shorter(self) -> Grams:
        """The expressions without their first character."""
        points = self.points.copy()
        points[np.arange(len(points)), ORDER - self.length] = 0
        return grams_of(points, self.length - 1)


def grams_of(points: np.ndarray, length: np.ndarray) -> Grams:
    return Grams(points, length, (points * FACTORS[ORDER - 1::-1]).sum(1, dtype=np.uint64))


def read_grams(texts: pa.Array) -> Grams:
    points, length = code_points(texts)
    table = np.zeros((len(length), ORDER), np.uint64)
    row = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
    table[row, ORDER - length[row] + place] = points
    return grams_of(table, length)


def shared_backoff(seen: Grams) -> tuple[np.ndarray, np.ndarray]:
    """Kneser-Ney probabilities of all shorter expressions, from both classes together: their
    numbers in order, and the probabilities."""
    levels, counts, level = [], [], seen
    while True:
        level = level.taken(np.flatnonzero(level.length > 1)).shorter()
        if not len(level.key):
            break
        _, rows, n = np.unique(level.key, return_index=True, return_counts=True)
        level = level.taken(rows)
        levels.append(level)
        counts.append(n)
    if not levels:
        return np.zeros(0, np.uint64), np.zeros(0)
    every = Grams(*[np.concatenate(parts) for parts in zip(*levels, strict=True)])
    key, rows, at = np.unique(every.key, return_index=True, return_inverse=True)
    total = np.bincount(at, np.concatenate(counts))
    every = every.taken(rows)
    context, of = np.unique(every.contexts(), return_inverse=True)
    of_context, followers = np.bincount(of, total), np.bincount(of)
    first = 1.0 / (followers[np.searchsorted(context, 0)] + 1)  # the empty context has the number 0
    found, suffix = np.zeros(len(key)), every.shorter().key
    for length in range(1, ORDER + 1):
        own = np.flatnonzero(every.length == length)
        lower = first if length == 1 else found[np.searchsorted(key, suffix[own])]
        found[own] = (total[own] - DISCOUNT + DISCOUNT * followers[of[own]] * lower) / of_context[of[own]]
    return key, found


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of some keys, not a number where a key is not there; ``keys`` are sorted."""
    if not len(keys):
        return np.full(len(wanted), np.nan)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], np.nan)


class Evidence(NamedTuple):
    """Log-likelihood differences by number, in the order of the numbers: of expressions seen in
    either class, and of contexts for characters that neither class has shown there."""

    seen: np.ndarray
    seen_value: np.ndarray
    unseen: np.ndarray
    unseen_value: np.ndarray

    def of_words(self, words: list[str]) -> np.ndarray:
        """The sum over the characters of each word."""
        points, length = code_points(pa.array([f"^{word}$" for word in words], pa.string()))
        place = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
        value = looked_up(self.seen, self.seen_value, windows(points, place, ORDER))
        new = np.flatnonzero(np.isnan(value) & (place > 0))
        context = windows(points, place, ORDER - 1)[new - 1]
        value[new] = np.nan_to_num(looked_up(self.unseen, self.unseen_value, context))
        value[place == 0] = 0.0  # the border before a word is no character of it
        return np.bincount(np.repeat(np.arange(len(words)), length), value, len(words))


NO_EVIDENCE = Evidence(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0))


def fit_evidence(grams: Grams, counts: tuple[np.ndarray, np.ndarray]) -> Evidence:
    """Evidence of toxic against ordinary text from the two classes' expression counts."""
    there = np.flatnonzero(counts[0] + counts[1] > 0)
    grams, counts = grams.taken(there), (counts[0][there], counts[1][there])
    shared_key, shared = shared_backoff(grams)
    lower = looked_up(shared_key, shared, grams.shorter().key)
    context, of = np.unique(grams.contexts(), return_inverse=True)
    chances, backoffs = [], []
    for n in counts:
        total, followers = np.bincount(of, n, len(context)), np.bincount(of, n > 0, len(context))
        backoff = np.where(total > 0, DISCOUNT * followers / np.maximum(total, 1), 1.0)
        chances.append(np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1)[of] + backoff[of] * lower)
        backoffs.append(backoff)
    order = np.argsort(grams.key)
    return Evidence(
        grams.key[order], np.log(chances[1] / chances[0])[order], context, np.log(backoffs[1] / backoffs[0])
    )


def word_features(values: list[float]) -> tuple[float, float, float]:
    """Difference per word: of the whole text, of its most toxic stretch and word; 0 without
    words."""
    if not values:
        return 0.0, 0.0, 0.0
    differences = np.array(values)
    width = min(STRETCH, len(values))
    sums = np.concatenate(([0.0], np.cumsum(differences)))
    stretch = (sums[width:] - sums[:-width]).max() / width
    return float(differences.mean()), float(stretch), float(differences.max())


def features(texts: list[bytes], evidence: Evidence, known: dict[str, float]) -> np.ndarray:
    """The features of some texts; what no text has shown before is looked up at once."""
    words = [words_of(text) for text in texts]
    if len(known) > KEPT:
        known.clear()
    new = list(dict.fromkeys(word for own in words for word in own if word not in known))
    known.update(zip(new, evidence.of_words(new).tolist(), strict=True))
    return np.array([word_features([known[word] for word in own]) for own in words]).reshape(-1, FEATURES)


class Model(NamedTuple):
    """Evidence and the regression over its features; ``constant`` where one class is absent."""

    evidence: Evidence
    weights: np.ndarray
    constant: float | None

    def score(self, found: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(found), self.constant)
        return 1 / (1 + np.exp(-np.clip(found @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit_regression(found: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights and intercept by Newton's method with a small ridge on scaled features."""
    mean, scale = found.mean(0), found.std(0) + 1e-9
    design = np.column_stack([(found - mean) / scale, np.ones(len(found))])
    weights = np.zeros(design.shape[1])
    ridge = RIDGE * np.append(np.ones(FEATURES), 0.0)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (chance - toxic) + ridge * weights
        curve = (design * (chance * (1 - chance))[:, None]).T @ design + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    own = weights[:-1] / scale
    return np.append(own, weights[-1] - own @ mean)


def fold(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, train_rows: int) -> DataFrame:
    """The labelled rows to learn from: ``text``, ``toxic`` and the ``half`` they are in."""
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
        .where(F.col("_id").isNotNull() & F.col("_toxic").isin(0, 1) & (fold("_id") != HELD_OUT))
        .groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    )
    sizes = {row["_toxic"]: row["n"] for row in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    grain = 1 << 30
    drawn = F.pmod(F.xxhash64("_id", F.lit(9)), F.lit(grain))
    limit = F.lit(0)
    for label, n in sizes.items():
        limit = F.when(F.col("_toxic") == label, int(min(1.0, train_rows / n) * grain)).otherwise(limit)
    # At most about 2 * train_rows rows of two numbers, whatever the tables hold.
    few = F.broadcast(known.where(drawn < limit))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(few, "_id").select("text", F.col("_toxic").alias("toxic"), (fold("_id") % 2).cast("int").alias("half"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[int, int], Counter] = {(half, label): Counter() for half in (0, 1) for label in (0, 1)}
    for batch in batches:
        for text, label, half in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            counts[half, label].update(words_of((text or "").encode()))
    for (half, label), words in counts.items():
        found: Counter = Counter()
        for word, n in words.items():
            for gram in grams(word):
                found[gram] += n
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([half] * len(found), pa.int32()), pa.array([label] * len(found), pa.int32()),
                pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64()),
            ],
            names=["half", "toxic", "gram", "n"],
        )


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """Learn from labelled rows whose crc32 of the identifier is not 0 modulo 5.

    Rows without identifier or label are not learnt from; of contradicting labels toxic
    counts.  Where a class is absent, every score is the smoothed share of toxic rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sample = durable(_sample(docs, labels, id_col, text_col, train_rows))
    sizes = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        n, toxic = sum(sizes.values()), sizes.get(1, 0)
        return Model(NO_EVIDENCE, np.zeros(FEATURES + 1), toxic / (n + 1))
    counted = sample.mapInArrow(_count, "half int, toxic int, gram string, n long")
    by_gram = counted.groupBy("gram").agg(*[
        F.sum(F.when((F.col("half") == half) & (F.col("toxic") == label), F.col("n")).otherwise(0)).alias(f"n{half}{label}")
        for half in (0, 1) for label in (0, 1)
    ])
    rows = by_gram.toArrow().combine_chunks()  # bounded by the sample
    every = read_grams(rows.column("gram").combine_chunks()) if rows.num_rows else read_grams(pa.array([], pa.string()))
    counts = {key: rows.column(f"n{key}").to_numpy() for key in ("00", "01", "10", "11")}
    del rows

    def evidence(halves: tuple[int, ...]) -> Evidence:
        classes = [np.sum([counts[f"{half}{label}"] for half in halves], axis=0) for label in (0, 1)]
        return fit_evidence(every, (classes[0], classes[1]))

    # Plain tuples of arrays, which a worker without this library can read.
    both = spark.sparkContext.broadcast((tuple(evidence((1,))), tuple(evidence((0,)))))

    def unseen_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[dict, dict] = ({}, {})
        models = [Evidence(*arrays) for arrays in both.value]
        for batch in batches:
            half = batch.column(2).to_numpy(zero_copy_only=False)
            for own in (0, 1):
                some = batch.filter(pa.array(half == own))
                texts = some.column(0).cast(pa.binary()).to_pylist()
                found = features([text or b"" for text in texts], models[own], known[own])
                yield pa.RecordBatch.from_arrays(
                    [some.column(1), *[pa.array(column, pa.float64()) for column in found.T]],
                    names=["toxic", "whole", "stretch", "word"],
                )

    told = sample.mapInArrow(unseen_features, "toxic int, whole double, stretch double, word double").toArrow()
    found = np.column_stack([told.column(name).to_numpy() for name in ("whole", "stretch", "word")])
    order = np.lexsort(found.T)  # the same fit whatever order the rows come in
    weights = fit_regression(found[order], told.column("toxic").to_numpy()[order])
    both.destroy()
    return Model(evidence((0, 1)), weights, None)


class Scorer:
    """A model as the tasks get it: plain arrays, under a name that no other model has."""

    def __init__(self, spark, model: Model) -> None:
        self.model = spark.sparkContext.broadcast((tuple(model.evidence), model.weights, model.constant))
        self.name = f"toxicity_{uuid.uuid4().hex}"

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        arrays, weights, constant = self.model.value
        model = Model(Evidence(*arrays), weights, constant)
        known = worker_state(self.name, dict)
        return model.score(features([text or b"" for text in texts], model.evidence, known))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``held_out`` and ``score`` of every row, from its text alone.

    Absent and empty texts and texts without words score as a text without any evidence;
    repeated rows are repeated; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scorer = Scorer(spark, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = scorer.scores(batch.column(2).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["id", "held_out", "score"]
            )

    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"), (fold(id_col) == HELD_OUT).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    return narrow.mapInArrow(score, "id long, held_out boolean, score double")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that score below the threshold.

    Absent and empty texts are judged as by ``score_documents``; repeated rows are judged alike, so
    all of them stay or go; columns of any name are kept; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scorer = Scorer(spark, model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array(scorer.scores(texts) < threshold, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
