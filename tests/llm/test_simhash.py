import random
import re

import numpy as np
import pytest
import xxhash

from trackmill.llm.components import components
from trackmill.llm.simhash import fingerprint, linked_rows, near_groups, near_links, one_of_each


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, links):
    least = {n: n for n in nodes}

    def find(n):
        while least[n] != n:
            n = least[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", "One", "one two", "ONE two three", "a b c d e f g h " * 40, "Ä Ö ü x\x0by\x1cz"])
def test_fingerprints(text):
    assert fingerprint(text.encode()) % 2 ** 64 == plain_fingerprint(text)


def near(a, b, radius):
    return (a ^ b).bit_count() <= radius


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_comparison(radius):
    choose = random.Random(radius)
    prints, cells = [], []
    for cell, size in enumerate([1, 2, 63, 64, 65, 200, 1]):
        centre, found = choose.getrandbits(64), set()
        while len(found) < size:
            own = centre
            for _ in range(choose.randint(0, 6)):
                own ^= 1 << choose.randrange(64)
            found.add(own)
        prints += sorted(found)
        cells += [cell] * size
    labels = linked_rows(np.array(cells), np.array(prints, np.uint64), radius)
    links = [
        (i, j) for i in range(len(prints)) for j in range(i) if cells[i] == cells[j] and near(prints[i], prints[j], radius)
    ]
    assert dict(enumerate(labels.tolist())) == classes(range(len(prints)), links)


@pytest.mark.parametrize("cell_rows", [8, 4096])
def test_links_connect_all_that_are_near(spark, cell_rows):
    choose = random.Random(3)
    prints = {choose.getrandbits(64) for _ in range(200)} | {2 ** 63, 2 ** 64 - 1, 0, 1, 3, 7}
    for centre in list(prints)[:30]:
        for _ in range(6):
            centre ^= 1 << choose.randrange(64)
            prints.add(centre)
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in prints]
    links = near_links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), 2, cell_rows)
    joined = {r["node"]: r["root"] for r in components(links).collect()}
    plain = classes(signed, [(a, b) for a in signed for b in signed if near(a % 2 ** 64, b % 2 ** 64, 2) and a != b])
    assert {p: joined.get(p, p) for p in signed} == plain


def test_components(spark):
    choose = random.Random(4)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(200)]
    loose = [(choose.randrange(2000, 2300), choose.randrange(2000, 2300)) for _ in range(120)] + [(5000, 5000), (None, 3)]
    links = spark.createDataFrame(chain + star + loose, "a long, b long")
    pairs = [(a, b) for a, b in chain + star + loose if a is not None and a != b]
    assert {r["node"]: r["root"] for r in components(links).collect()} == {
        n: root for n, root in classes({n for pair in pairs for n in pair}, pairs).items() if n != root
    }
    assert components(links.limit(0)).count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = near_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    told = {r["id"]: r for r in rows if r["id"] is not None}
    assert told[0]["component_id"] == told[1]["component_id"] == 0
    assert {told[2]["component_id"], told[3]["component_id"]} == {2}
    assert all(r["component_id"] is not None for r in rows if r["fingerprint"] == 0)
    kept = one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # Row 6 of blanks and the rows without a text are like row 2; one of its group stays.
    assert sorted(i for i in ids if i is not None) == [0, 2, 4, 5, 6]
    assert ids.count(None) == 1
    assert near_groups(no_docs).count() == 0 and one_of_each(no_docs).count() == 0


def test_repeated_identifiers_and_any_column_names(spark):
    """Of (3, A), (5, B), (5, A with another word) and repeats, one row of each group stays."""
    a, b = " ".join(f"w{i}" for i in range(4000)), "an ordinary text of its own"
    rows = [(3, a), (5, b), (5, a + " more"), (5, b), (None, b), (None, "alone"), (None, "alone"), (7, a)]
    columns = "doc_id long, text string, _hash int, _id int, _row string, _own int, _text int, fingerprint int, id int"
    docs = spark.createDataFrame([(*r, 1, 2, "r", 3, 4, 5, 6) for r in rows], columns)
    assert near(fingerprint(a.encode()) % 2 ** 64, fingerprint((a + " more").encode()) % 2 ** 64, 2)
    kept = one_of_each(docs.repartition(3))
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(3, a), (5, b), (None, "alone")], key=str)
