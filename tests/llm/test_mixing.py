import hashlib
import random
from fractions import Fraction

import pytest

from trackmill.llm.mixing import fair_mix, mixed, source_targets
from trackmill.llm.prefix import running_sums


def targets_of(sizes, weights=(5, 2, 1), most=3):
    """Share, hold what is above its limit, share the rest, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    held, total = {}, sum(sizes.values())
    while True:
        free = [n for n in names if n not in held]
        rest = total - sum(held.values())
        share = {n: Fraction(rest * weight[n], sum(weight[m] for m in free)) for n in free}
        over = [n for n in free if share[n] > most * sizes[n]]
        if not over:
            return {**{n: float(v) for n, v in held.items()}, **{n: float(v) for n, v in share.items()}}
        held |= {n: most * sizes[n] for n in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets_against_brute_force(spark, seed):
    choose = random.Random(seed)
    sizes = {f"s{i}": choose.randint(0, 10 ** choose.randint(1, 6)) for i in range(choose.randint(1, 12))}
    sizes[None] = 40
    rows = [(name, part) for name, size in sizes.items() for part in (size // 2, size - size // 2)]
    found = source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    assert {r["source"]: r["source_size"] for r in found} == sizes
    assert {r["source"]: r["target"] for r in found} == pytest.approx(targets_of(sizes))


def test_mix_meets_targets(spark):
    choose = random.Random(1)
    rows = [(i, "w " * choose.randint(0, 60), choose.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = fair_mix(docs).collect()
    again = fair_mix(docs.repartition(3)).collect()
    assert sorted((r["id"], r["taken"]) for r in found) == sorted((r["id"], r["taken"]) for r in again)
    taken, target = {}, {}
    for row in found:
        taken[row["source"]] = taken.get(row["source"], 0) + row["taken"]
        target[row["source"]] = row["target"]
        assert 0 <= row["taken"] <= 3 * row["size"] and row["taken"] == row["copies"] * row["size"]
    for source, words in taken.items():
        assert abs(words - target[source]) <= 120
    assert sum(taken.values()) <= sum(row["size"] for row in found)
    # The mixed documents are these copies.
    copies = {r["doc_id"]: r["count"] for r in mixed(docs).groupBy("doc_id").count().collect()}
    assert copies == {r["id"]: r["copies"] for r in found if r["copies"]}


def test_shuffled_order(spark):
    docs = spark.createDataFrame([(i, "x y", "only") for i in range(8)], "doc_id long, text string, source string")
    assert [r["taken"] for r in fair_mix(docs).collect()] == [2] * 8
    order = sorted(range(8), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert len(set(order)) == 8


def test_odd_rows(odd_docs, no_docs):
    found = fair_mix(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert {r["size"] for r in found if r["id"] in (2, 3)} == {0}
    out = mixed(odd_docs)
    assert out.columns == odd_docs.columns
    rows = [tuple(r) for r in out.collect()]
    # Texts without words pass once; no row passes more than three times.
    assert sum(r[0] == 3 for r in rows) == 2
    assert max(rows.count(r) for r in rows) <= 3
    assert fair_mix(no_docs).count() == 0 and mixed(no_docs).count() == 0


def test_running_sums(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS v").repartition(6)
    found = running_sums(df, ["id"], {"to": "v"}).orderBy("id").collect()
    total = 0
    for row in found:
        total += row["v"]
        assert row["to"] == total


def test_mixed_keeps_any_columns_and_shares_out_repeated_rows(spark):
    rows = [(1, "a b c", "x")] * 4 + [(2, "d e", None), (None, None, None), (None, None, None), (3, "f g h i", "y")]
    names = "_key int, _twin int, _copy int, _copies int, _other int, _row int, _rows int, _times int, position int"
    docs = spark.createDataFrame([(*r, *range(9)) for r in rows], "doc_id long, text string, source string, " + names)
    found = mixed(docs.repartition(3))
    assert found.columns == docs.columns
    assert all(tuple(r)[3:] == tuple(range(9)) for r in found.collect())
    told = {}
    for r in fair_mix(docs).collect():
        told[r["id"], r["source"]] = told.get((r["id"], r["source"]), 0) + r["copies"]
    counted = {(r["doc_id"], r["source"]): r["count"] for r in found.groupBy("doc_id", "source").count().collect()}
    assert counted == {key: n for key, n in told.items() if n}
