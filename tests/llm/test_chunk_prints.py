import hashlib
import random

import numpy as np
import pytest
import xxhash

from trackmill.llm import chunk_prints as cp
from trackmill.llm.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


def plain_ends(data):
    """Chunk ends byte by byte."""
    hashes = []
    for i in range(len(data)):
        value = 0
        for back in range(cp.SPAN):
            if i >= back:
                value += int(cp.GEAR[data[i - back]]) << back
        hashes.append(value & 0xFFFFFFFF)
    ends, start = [], 0
    for i in range(len(data)):
        size = i + 1 - start
        bits = cp.STRICT_BITS if size <= cp.NORMAL else cp.LOOSE_BITS
        ends_here = size >= cp.LEAST and len(data) - start > cp.LEAST and hashes[i] >> (32 - bits) == 0
        if ends_here or size == cp.MOST or i == len(data) - 1:
            ends.append(i + 1)
            start = i + 1
    return ends


def plain_prints(data):
    found, start = set(), 0
    for end in plain_ends(data):
        found.add(xxhash.xxh64_intdigest(data[start:end], cp.SEED) >> 16 << 16 | (end - start))
        start = end
    return found


def plain(rows):
    """All rows, by one loop over the table in order."""
    texts = [(i, t or "") for i, t in rows]
    texts.sort(key=lambda r: (r[0] is None, -(r[0] or 0), spark_hash(r[1]), r[1].encode()))
    share = lambda a, b: (sum(x & 0xFFFF for x in a & b) / sum(x & 0xFFFF for x in a)) if a else float(not b)
    digits = lambda own: "".join(f"{x:016x}" for x in sorted(own))
    for at, (identifier, text) in enumerate(texts):
        behind = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        changed = text[:len(text) - half] + behind[:half]
        own, after, other = (plain_prints(x.encode()) for x in (text, changed, behind))
        yield (
            identifier, len(text), hashlib.sha256(changed.encode()).hexdigest(), digits(own), digits(after),
            share(own, after), share(own, other),
        )


def spark_hash(text):
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).view(np.int64))


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_odd_rows(odd_docs, ranges):
    rows = [(row["doc_id"], row["text"]) for row in odd_docs.collect()]
    rows = [(i, t) for i, t in rows if len(t or "") < 10_000]
    docs = odd_docs.where("text IS NULL OR length(text) < 10000").repartition(3)
    found = cp.chunk_prints(docs, ranges=ranges)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain(rows), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(row["doc_id"], row["text"]) for row in docs.select("doc_id", "text").collect()]
    short = {i for i, t in rows if len(t or "") < 3000}
    found = {row["doc_id"]: tuple(row) for row in REGISTRY["op12_chunk_prints"].run(spark, SF_DIR).collect()}
    assert len(found) == len(rows)
    order = sorted(rows, key=lambda r: -r[0])
    for (i, text), (j, behind) in zip(order, order[1:] + order[:1], strict=True):
        changed = cp.edited(text or "", behind or "")
        assert found[i][1:3] == (len(text or ""), hashlib.sha256(changed.encode()).hexdigest())
        if i in short and i % 10 == 0:
            own, after, other = (plain_prints((x or "").encode()) for x in (text, changed, behind))
            assert found[i][3] == "".join(f"{x:016x}" for x in sorted(own))
            assert found[i][4] == "".join(f"{x:016x}" for x in sorted(after))
            weigh = lambda prints: sum(x & 0xFFFF for x in prints)
            assert found[i][5] == (weigh(own & after) / weigh(own) if own else float(not after))
            assert found[i][6] == (weigh(own & other) / weigh(own) if own else float(not other))


def test_a_very_long_text(odd_docs):
    longest = max(cp.chunk_prints(odd_docs).collect(), key=lambda row: row["n_chars"])
    # One word, again and again: a few chunks, of which only those at the ends may differ.
    assert longest["n_chars"] == 150_000 and longest["near_edited"] > 0.7


def test_empty_and_lone(spark, no_docs):
    assert cp.chunk_prints(no_docs).count() == 0
    assert cp.chunk_prints(no_docs).columns == [field.split()[0] for field in cp.PRINTS.split(", ")]
    lone = spark.createDataFrame([(7, "one text alone, somewhat longer than a chunk")], "doc_id long, text string")
    row = cp.chunk_prints(lone, ranges=5).first()
    assert (row["id"], row["near_next"]) == (7, 1.0)


def test_an_insertion_keeps_far_chunks():
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(600)).encode()
    moved = text[:1500] + b"some words put in" + text[1500:]
    own, other = cp.fingerprint(text), cp.fingerprint(moved)
    assert 0.9 < cp.containment(own, other) < 1.0
    assert cp.containment(own, own) == 1.0
    ends = cp.chunk_ends(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes[:-1].min() >= cp.LEAST and sizes.max() <= cp.MOST


def test_many_rows_of_one_identifier_meet_in_many_tasks(spark):
    docs = spark.range(2000).selectExpr("IF(id % 3 = 0, 5, id) AS doc_id", "concat('text number ', id) AS text")
    firsts = cp.range_starts(docs.selectExpr("doc_id AS id", "xxhash64(text) AS hash"), 16)
    assert sum(identifier == 5 for identifier, _ in firsts) >= 4
    assert cp.chunk_prints(docs, ranges=16).count() == 2000
