import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trackmill.llm.simple8b import choose, decode, encode
from trackmill.llm.subwords import Subwords, load
from trackmill.llm.token_files import END_ID, pack_block, token_files, unpack_block


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 300), st.integers(0, 2 ** 64 - 1)), max_size=400))
def test_round_trip(values):
    packed = encode(np.array(values, np.uint64))
    assert decode(packed).tolist() == values


def test_words_pack_as_many_as_fit():
    assert len(encode(np.zeros(120, np.uint64))) == 1
    assert len(encode(np.full(60, 1, np.uint64))) == 1
    assert len(encode(np.full(3, 50_000, np.uint64))) == 1
    assert len(encode(np.full(1, 2 ** 63, np.uint64))) == 2  # an escape and the value
    assert choose(np.zeros(0, np.uint64)).tolist() == []


@pytest.fixture(scope="module")
def subwords():
    return Subwords()


TEXTS = [
    "", " ", "a", " a", "a b", "a  b", "a\nb", "a \n b", "a\n\nb c", "a\n", "\na", "It's 's a' b.", "x1. y2, z!",
    "Grüße, 中文 字. \U0001f600", "a\tb c\td", "<|endoftext|> <s>", "one, two. three\nFour five", "a b   c",
]


def test_ids_are_the_librarys(subwords):
    whole = [found.ids for found in load().encode_batch(TEXTS, add_special_tokens=False)]
    for _ in range(2):  # the second time from what it has kept
        assert [np.frombuffer(ids, "<u4").tolist() for ids in subwords.encode(TEXTS)] == whole


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'., \n\té1中", max_size=30))
def test_any_text(subwords, text):
    assert np.frombuffer(subwords.encode([text])[0], "<u4").tolist() == load_once().encode(text, add_special_tokens=False).ids


def load_once(kept=[]):  # noqa: B006
    if not kept:
        kept.append(load())
    return kept[0]


def test_blocks():
    ids = [np.array([5, 2], "<u4"), np.array([2], "<u4"), np.arange(1000, dtype="<u4")]
    names, back = unpack_block(pack_block([3, None, -4], ids))
    assert names == [3, None, -4]
    assert [own.tolist() for own in back] == [own.tolist() for own in ids]
    with pytest.raises(ValueError):
        unpack_block(b"....")


def test_files(odd_docs, no_docs):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    at, expected = 0, []
    for identifier, text in rows:
        ids = np.array(load_once().encode(text, add_special_tokens=False).ids + [END_ID], "<u4")
        expected.append((identifier, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    found = [(r["id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files(odd_docs).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected
    assert token_files(no_docs).count() == 0
