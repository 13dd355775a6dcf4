import hashlib
from collections import defaultdict

import pytest

from trackmill.llm.exact_dedup import exact_groups, narrowest, rounds_for


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(rows, keep):
    groups = defaultdict(list)
    for identifier, text in rows:
        groups[lowered(text)].append(identifier)
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        winner = (min if keep == "smallest" else max)(known) if known else None
        for identifier in ids:
            yield identifier, winner, len(ids), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("parts", [1, 7])
def test_against_brute_force(odd_docs, keep, parts):
    docs = odd_docs.repartition(parts)
    found = exact_groups(docs, keep=keep).collect()
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    told = sorted(((r["id"], r["keep_id"], r["group_size"], r["sha256"]) for r in found), key=str)
    assert told == sorted(expected(rows, keep), key=str)
    # One row of each group stays, also where identifiers repeat or are absent.
    stays = defaultdict(int)
    for row in found:
        stays[row["sha256"]] += row["kept"]
    assert set(stays.values()) == {1}


def test_many_copies_over_many_runs(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'Hot', concat('t', id % 500)) AS text")
    found = exact_groups(docs.repartition(23), fan=3).where("kept").collect()
    assert sum(row["group_size"] for row in found) == 3000
    assert {row["group_size"] for row in found if row["keep_id"] == 2997} == {1000}
    assert len(found) == 501


@pytest.mark.parametrize("most_nodes", [1, 4, 5])
def test_runs_share_bounded_nodes(spark, most_nodes):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'Hot', concat('t', id % 500)) AS text")
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    found = exact_groups(docs.repartition(23), fan=3, most_nodes=most_nodes)
    told = sorted(((r["id"], r["keep_id"], r["group_size"], r["sha256"]) for r in found.collect()), key=str)
    assert told == sorted(expected(rows, "largest"), key=str)
    assert found.where("kept").count() == 501


def test_empty_table(no_docs):
    assert exact_groups(no_docs).count() == 0


def test_rounds():
    assert [rounds_for(n, 16) for n in (1, 16, 17, 256, 257)] == [1, 1, 2, 2, 3]
    assert narrowest(32, 2) ** 2 >= 32 > (narrowest(32, 2) - 1) ** 2


def test_unknown_choice(odd_docs):
    with pytest.raises(ValueError):
        exact_groups(odd_docs, keep="any")
