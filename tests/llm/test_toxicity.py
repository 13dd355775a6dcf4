import random
import zlib

import numpy as np
import pytest

import pyarrow as pa
from plain_kneser_ney import plain_evidence, plain_shared, word_evidence

from trackmill.llm.toxicity import (
    fit_evidence,
    grams,
    read_grams,
    score_documents,
    shared_backoff,
    train,
    without_toxic,
)

SYLLABLES = ["ra", "ti", "no", "be", "shu", "lo", "ke"]


def corpus(n, seed=0):
    choose = random.Random(seed)
    for i in range(n):
        words = ["".join(choose.choice(SYLLABLES) for _ in range(choose.randint(1, 4))) for _ in range(choose.randint(5, 60))]
        toxic = int(choose.random() < 0.3)
        if toxic:
            for _ in range(2):
                words.insert(choose.randrange(len(words)), "zwick" + choose.choice(SYLLABLES))
        yield i, " ".join(words), toxic


@pytest.fixture(scope="module")
def tables(spark):
    rows = list(corpus(500))
    docs = spark.createDataFrame([(i, text, "x", 0.5) for i, text, _ in rows], "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, toxic) for i, _, toxic in rows], "doc_id long, toxic int")
    return docs, labels, {i: toxic for i, _, toxic in rows}


@pytest.fixture(scope="module")
def model(tables):
    return train(tables[0], tables[1])


def test_held_out_accuracy(tables, model):
    rows = score_documents(tables[0], model).collect()
    assert len(rows) == 500
    held = [r for r in rows if r["held_out"]]
    assert {r["id"] for r in held} == {i for i in tables[2] if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [(r["score"] >= 0.5) == bool(tables[2][r["id"]]) for r in held]
    assert np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_are_not_learnt_from(tables, model):
    docs, labels, _ = tables
    turned = labels.selectExpr("doc_id", "IF(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    again = train(docs, turned)
    assert np.allclose(again.weights, model.weights)
    assert all(np.array_equal(a, b) for a, b in zip(again.evidence, model.evidence, strict=True))


def test_filter_keeps_clean_documents(tables, model):
    docs, _, toxic = tables
    kept = without_toxic(docs, model)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & {i for i, t in toxic.items() if not t}) >= 0.98 * sum(not t for t in toxic.values())


def test_backoff_is_a_distribution():
    names = sorted({*grams("banana"), *grams("bandana")})
    key, chance = shared_backoff(read_grams(pa.array(names)))
    singles = read_grams(pa.array(sorted("^$band"))).key
    assert 0 < chance[np.isin(key, singles)].sum() <= 1
    counts = tuple(np.array([n * (name in grams(word)) for name in names]) for n, word in ((3, "banana"), (2, "bandana")))
    toxic, ordinary = fit_evidence(read_grams(pa.array(names)), counts).of_words(["bandana", "banana"])
    assert toxic > 0 > ordinary


@pytest.mark.parametrize("seed", range(3))
def test_evidence_against_counting_strings(seed):
    """The same Kneser-Ney models by dictionaries of strings."""
    choose = random.Random(seed)
    letters = "abcé\U0001f600漢"
    words = ["".join(choose.choice(letters) for _ in range(choose.randint(1, 9))) for _ in range(300)]
    classes = ({}, {})
    for word in words[:200]:
        own = classes[choose.random() < 0.4]
        for gram in grams(word):
            own[gram] = own.get(gram, 0) + choose.randint(1, 3)
    names = sorted(set(classes[0]) | set(classes[1]))
    every = read_grams(pa.array(names))
    shared, (key, chance) = plain_shared(set(names)), shared_backoff(every)
    assert len(key) == len(shared)
    wanted = read_grams(pa.array(list(shared))).key
    assert np.allclose(chance[np.searchsorted(key, wanted)], list(shared.values()))
    found = fit_evidence(every, tuple(np.array([own.get(name, 0) for name in names]) for own in classes))
    plain = plain_evidence(classes)
    assert np.allclose(found.of_words(words), [word_evidence(plain, word) for word in words])


def test_odd_rows(odd_docs, no_docs, tables, model):
    scored = score_documents(odd_docs, model).collect()
    assert len(scored) == odd_docs.count()
    bare = {r["score"] for r in scored if r["id"] in (2, 3)}
    assert len(bare) == 1 and bare.pop() < 0.5
    assert score_documents(no_docs, model).count() == 0 and without_toxic(no_docs, model).count() == 0


def test_few_labels(spark, tables, odd_docs):
    docs, labels, _ = tables
    none = train(docs, labels.limit(0))
    assert {r["score"] for r in score_documents(docs, none).collect()} == {0.0}
    clean = train(docs, labels.where("toxic = 0"))
    assert {r["score"] for r in score_documents(docs, clean).collect()} == {0.0}
    odd = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (None, 1), (4, None), (99, 1), (5, 7)], "doc_id long, toxic int")
    assert score_documents(odd_docs, train(odd_docs, odd)).count() == odd_docs.count()


def test_bounded_sample(tables):
    model = train(tables[0], tables[1], train_rows=60)
    found = score_documents(tables[0], model).where("held_out").collect()
    assert np.mean([(r["score"] >= 0.5) == bool(tables[2][r["id"]]) for r in found]) > 0.9
