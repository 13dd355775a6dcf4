import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from trackmill.llm import collocations as co


def plain_pieces(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered)]


def plain(rows, most_words=3, least=10, held=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        for words in plain_pieces(text):
            totals[lang or "und"] += len(words)
            for size in range(1, most_words + 1):
                counts[lang or "und"].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        gone = {
            longer[i:j] for longer, a in candidates.items() for i in range(len(longer)) for j in range(i + 1, len(longer) + 1)
            if j - i < len(longer) and 100 * a >= held * own[longer[i:j]]
        }
        scored = []
        for phrase, a in candidates.items():
            if phrase in gone:
                continue
            score, _, k = min((1_000_000 * a * a // (own[phrase[:k]] * own[phrase[k:]]), k, k) for k in range(1, len(phrase)))
            text = " ".join(phrase)
            scored.append((-score, -a, text.encode(), text, a, own[phrase[:k]], own[phrase[k:]], totals[lang], score))
        for rank, (*_, text, a, left, right, n, score) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, text, a, left, right, n, score))
    return found


def texts(seed, many=300, words="abcdefgh"):
    rng = random.Random(seed)
    ends = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!", " ", "\x1c"]
    for _ in range(many):
        yield "".join(rng.choice(words) * rng.randint(1, 2) + rng.choice(ends) for _ in range(rng.randint(0, 40)))


@pytest.mark.parametrize("settings", [
    {}, {"most_words": 2}, {"most_words": 4}, {"top": 7}, {"least_count": 3, "held_percent": 20},
    {"shard_words": 50, "filter_bits": 32}, {"shard_words": 700, "open_words": 100, "filter_bits": 1024},
])
def test_random_texts(spark, settings):
    rows = [((None, "de", "en", "und")[i % 4], text) for i, text in enumerate(texts(1))]
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "lang string, text string, n int, phrase string, size string")
    found = sorted(map(tuple, co.collocations(docs.repartition(3), **settings).collect()))
    names = {"least_count": "least", "held_percent": "held", "most_words": "most_words", "top": "top"}
    expected = plain(rows, **{names[k]: v for k, v in settings.items() if k in names})
    assert found == sorted(expected) and found


def test_odd_rows(spark, odd_docs, no_docs):
    assert co.collocations(no_docs).count() == 0
    rows = [(row["lang"], row["text"]) for row in odd_docs.collect()]
    found = co.collocations(odd_docs, shard_words=10_000)
    assert sorted(map(tuple, found.collect())) == sorted(plain(rows))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_one_phrase_in_most_places_of_one_language(spark):
    rows = [("en", f"hot phrase here and word{i} hot phrase {'x' * (i % 5)}") for i in range(900)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, co.collocations(docs, shard_words=500).collect())) == sorted(plain(rows))


def test_intervals_against_counting():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 6, 4000).astype(np.int32)
    ids[-1] = 0
    for depth in (2, 3, 5):
        found = co.Intervals(co.transform(ids, 6, depth), 6)
        for size in range(1, depth + 1):
            if size > 1:
                found.extend()
            rows = zip(*[own.tolist() for own in found.words(found.starts)], strict=True)
            told = dict(zip(rows, found.sizes.tolist(), strict=True))
            wanted = Counter(tuple(ids[i:i + size].tolist()) for i in range(len(ids) - size + 1))
            assert told == {phrase: n for phrase, n in wanted.items() if 0 not in phrase}


def test_extension_needs_both_ends():
    words = [0, 1, 2, 3, 0, 1, 2, 0, 2, 3, 0]
    found = co.Intervals(co.transform(np.array(words, np.int32), 4, 3), 4)
    found.extend()
    pairs = list(zip(*[own.tolist() for own in found.words(found.starts)], strict=True))
    assert pairs == [(1, 2), (2, 3)]
    for gone in range(2):
        again = co.Intervals(co.transform(np.array(words, np.int32), 4, 3), 4)
        again.extend()
        kept = np.ones(again.number, bool)
        kept[again.at[again.starts[gone]]] = False
        again.extend(kept)
        assert len(again.starts) == 0
    found.extend(np.ones(found.number, bool))
    assert [own.tolist() for own in found.words(found.starts)] == [[1], [2], [3]] and found.sizes.tolist() == [1]


def test_wide_numbers_sort_alike():
    """More words than fit into one key of 63 bits."""
    ids = np.random.default_rng(5).integers(0, 50, 3000).astype(np.int32)
    narrow, wide = (co.Intervals(co.transform(ids, n, 3), 50) for n in (50, 1 << 22))
    for found in (narrow, wide):
        found.extend()
        found.extend()
    assert (narrow.starts == wide.starts).all() and (narrow.sizes == wide.sizes).all()


def test_filter_places_agree_with_spark(spark):
    import xxhash
    from pyspark.sql import functions as F

    phrases = ["a b", "über straße", "x \U0001f600", "hot hot"]
    frame = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    told = [row[0] for row in frame.select(co.filter_place(F.col("phrase"), 2, 1 << 20)).collect()]
    hashes = [np.array([xxhash.xxh64_intdigest(p.split(" ")[i], co.SEED) for p in phrases], np.uint64) for i in (0, 1)]
    assert told == co.filter_places(hashes, 1 << 20).tolist()
    bits = np.frombuffer(co.filter_of(frame, 2, 1 << 20), np.uint8)
    assert all(bits[place >> 3] >> (place & 7) & 1 for place in told)
    assert sum(int(b).bit_count() for b in bits[bits > 0]) == len(set(told))
