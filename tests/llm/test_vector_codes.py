import hashlib
import math

import numpy as np
import pytest

from trackmill.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label string, code string, id long, error string, _label int"


def plain(rows, parts, entries, rounds):
    """The same in plain loops, without bounds."""
    kept = [
        (i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    first = next((v for _, v, _ in kept if v and len(v) % parts == 0), None)
    if first is None:
        return [], ""
    width = len(first) // parts
    kept = [row for row in kept if len(row[1]) == len(first)]
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[own[p] for own in cut[:entries]] for p in range(parts)]

    def look(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            near = [look(own[p], books[p])[1] for own in cut]
            for e in set(near):
                own = [c[p] for c, n in zip(cut, near, strict=True) if n == e]
                books[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    found = []
    for (i, _, label), own in zip(kept, cut, strict=True):
        best = [look(own[p], books[p]) for p in range(parts)]
        found.append((i, label, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    errors = {}
    for _, label, _, error in found:
        errors[label] = errors.get(label, 0) + error
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [(*row, errors[row[1]]) for row in found], text


def compare(spark, rows, parts=4, entries=5, rounds=2):
    frame = spark.createDataFrame([(*r, "x", 7, "y", 1) for r in rows], SCHEMA).repartition(3)
    coded, books = vc.vector_codes(frame, parts=parts, entries=entries, rounds=rounds)
    expected, text = plain(rows, parts, entries, rounds)
    assert sorted(map(tuple, coded.collect()), key=str) == sorted(expected, key=str)
    assert vc.codebook_text(books) == text
    assert vc.codebook_digest(books) == hashlib.sha256(text.encode()).hexdigest()


def test_random_vectors(spark):
    random = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in random.normal(0, 0.02, 8)], "ab"[i % 2]) for i in random.permutation(300)]
    compare(spark, rows)
    compare(spark, rows, parts=2, entries=64)
    compare(spark, rows, parts=8, entries=1, rounds=0)


def test_odd_rows(spark):
    rows = [
        (1, [0.0] * 8, None), (1, [0.0] * 8, None), (2, [1.0] * 8, "a"), (2, [-1.0] * 8, "a"), (None, [0.5] * 8, None),
        (3, None, "a"), (4, [0.0] * 7 + [None], "a"), (5, [0.0] * 7 + [float("nan")], "a"), (6, [float("inf")] * 8, "b"),
        (7, [], "b"), (8, [0.1] * 7, "b"), (9, [0.1] * 12, "b"), (10, [-0.001] * 8, "c"),
    ]
    compare(spark, rows)
    compare(spark, rows, entries=64)


def test_nothing_to_code(spark):
    for rows in ([], [(1, None, "a"), (2, [float("nan")] * 8, "a"), (3, [1.0] * 3, "a")]):
        frame = spark.createDataFrame([(*r, "x", 7, "y", 1) for r in rows], SCHEMA)
        coded, books = vc.vector_codes(frame, parts=4)
        assert coded.columns == ["id", "label", "code", "error", "label_error"]
        assert coded.count() == 0 and vc.codebook_text(books) == ""


def test_one_vector_very_often(spark):
    rows = [(i, [0.25, -0.25, 0.5, 1.0], "hot") for i in range(400)] + [(1000 + i, [i / 7, i / 5, 0.0, -i / 3], None) for i in range(60)]
    compare(spark, rows, parts=2, entries=16)


def test_components_too_large(spark):
    frame = spark.createDataFrame([(1, [1e9] * 4, "a", "x", 7, "y", 1)], SCHEMA)
    with pytest.raises(OverflowError):
        vc.vector_codes(frame, parts=4)


def test_bounds_prune_and_never_lose_the_nearest():
    random = np.random.default_rng(2)
    points, entries = random.integers(-300, 300, (2000, 4)), random.integers(-300, 300, (64, 4))
    entries[40] = entries[3]  # a tie, which the lower index wins
    places = vc.pivots_of(entries[None], 6)[0]
    at, square, seen = vc.nearest(points, vc.distances(points, places), entries, vc.distances(entries, places))
    all_ = ((points[:, None] - entries[None]) ** 2).sum(-1)
    assert (at == all_.argmin(1)).all() and (square == all_.min(1)).all()
    assert seen < 0.2 * all_.size
