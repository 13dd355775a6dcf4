import random

import pytest

from trackmill.llm.decontaminate import Masks, Matcher, bit_parallel, find_leaks, pieces_of, without_leaks


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def least_edits(item, words):
    return min(edits(item, words[i:j]) for i in range(len(words) + 1) for j in range(i, min(len(words), i + 2 * len(item)) + 1))


@pytest.mark.parametrize("seed", range(20))
def test_bit_parallel_against_the_table(seed):
    choose = random.Random(seed)
    item = [choose.choice("abcd") for _ in range(choose.randint(1, 70))]
    words = [choose.choice("abcde") for _ in range(40)]
    anchored = list(bit_parallel(Masks(item).forward, len(item), words, True))
    assert anchored == [edits(item, words[:n]) for n in range(1, 41)]
    free = list(bit_parallel(Masks(item).forward, len(item), words, False))
    assert free == [min(edits(item, words[i:n]) for i in range(n + 1)) for n in range(1, 41)]


@pytest.mark.parametrize("seed", range(30))
def test_leaks_against_brute_force(seed):
    choose = random.Random(seed)
    names = [f"w{i}" for i in range(25)]
    item = [choose.choice(names) for _ in range(choose.randint(8, 24))]
    planted = list(item)
    for _ in range(choose.randint(0, 6)):
        at = choose.randrange(len(planted))
        planted[at:at + choose.randint(0, 1)] = [choose.choice(names)] * choose.randint(0, 2)
    words = [choose.choice(names) for _ in range(20)] + planted + [choose.choice(names) for _ in range(20)]
    found = Matcher([(7, item)], 0.2).leaks(" ".join(words).encode())
    budget = int(len(item) * 0.2)
    least = least_edits(item, words)
    assert bool(found) == (least <= budget)
    for item_id, first, last, distance, n in found:
        assert item_id == 7 and n == len(item)
        assert edits(item, words[first:last + 1]) == distance <= budget
    if found:
        assert min(row[3] for row in found) == least


def test_pieces_cover_the_item():
    words = list("abcdefghijklm")
    for budget in range(6):
        pieces = pieces_of(words, budget)
        assert len(pieces) == budget + 1
        assert [w for _, piece in pieces for w in piece] == words


ITEM = "one two three four five six seven eight nine ten eleven twelve"


def test_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, ITEM), (1, ITEM), (2, "too short"), (3, None), (None, ITEM)], "item_id long, text string"
    )
    leaky = [
        (10, "So: ONE two, three four five six seven eight nine ten eleven twelve!"),
        (11, "one two three FOUR-AND five six seven eight ten eleven twelve"),
        (12, "one two three four six nine five ten"),
        (10, "So: ONE two, three four five six seven eight nine ten eleven twelve!"),
    ]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(leaky, "doc_id long, text string"))
    found = find_leaks(docs, items).collect()
    assert sorted((r["id"], r["item_id"], r["first_word"], r["last_word"], r["distance"]) for r in found) == [
        (10, 1, 1, 12, 0), (10, 1, 1, 12, 0), (11, 1, 0, 11, 2)
    ]
    # Blocks of items change nothing.
    assert find_leaks(docs, items, block_chars=1).count() == 3
    kept = without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([r["doc_id"] for r in odd_docs.collect()] + [12], key=str)
    assert find_leaks(no_docs, items).count() == 0
    assert find_leaks(docs, items.limit(0)).count() == 0
    assert without_leaks(docs, items.limit(0)).count() == docs.count()


def test_short_items_must_occur_exactly():
    matcher = Matcher([(1, "what is the capital of france".split())], 0.2)
    assert matcher.leaks(b"Q: What is the capital of France?") == [(1, 1, 6, 0, 6)]
    assert matcher.leaks(b"What was the capital of France?") == []


def test_unspaced_scripts_are_matched_by_characters(spark):
    item = "\u660e\u6708\u51e0\u65f6\u6709\uff0c\u628a\u9152\u95ee\u9752\u5929\u3002\u4e0d\u77e5\u5929\u4e0a\u5bab\u9619"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "so: \u6211\u8bf4" + item + "\u597d\u7684 end"), (2, item.replace("\u9152", "\u8336")),
        (3, item[:6]), (4, item.replace("\uff0c", "\u3000")), (5, "only words"),
    ], "doc_id long, text string")
    found = {(r["id"], r["first_word"], r["last_word"], r["distance"], r["n_item_words"]) for r in find_leaks(docs, items).collect()}
    assert found == {(1, 1, 1, 0, 16), (2, 0, 0, 1, 16), (4, 0, 0, 0, 16)}
    assert sorted(r["doc_id"] for r in without_leaks(docs, items).collect()) == [3, 5]
