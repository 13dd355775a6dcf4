import re

import pytest

from trackmill.llm.license_scan import (
    BASE_PHRASES,
    automaton,
    evaluate,
    licence_summary,
    postfix,
    scan_licenses,
    scan_text,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_places(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), sorted(
        (at, label) for phrase, label in BASE_PHRASES.items()
        for at in range(len(words)) if words[at:at + len(phrase.split())] == phrase.split()
    )


TEXTS = [
    "Released under the MIT License. Under-the/MIT:license!",
    "cc by nc by nc cc by nc cc BY-NC", "apache license version 2 0", "apache license version 20",
    "sunder the mit license", "under the mit licensed", "", "Ünder the mit license under the MIT LICENSE",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_against_brute_force(text):
    n_words, hits, _, _ = scan_text(text.encode(), automaton())
    assert n_words == base_places(text)[0]
    assert sorted((hit["start"], hit["label"]) for hit in hits if hit["base"]) == base_places(text)[1]


def test_odd_rows(odd_docs, no_docs):
    rows = licence_summary(scan_licenses(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    told = sorted(((r["id"], r["n_words"], r["n_base"]) for r in rows), key=str)
    assert told == sorted(
        ((r["doc_id"], base_places(r["text"])[0], len(base_places(r["text"])[1])) for r in odd_docs.collect()), key=str
    )
    first = next(r for r in rows if r["id"] == 0)
    assert (first["first_word"], first["last_word"], first["base_labels"]) == (0, 0, "mit")
    bare = next(r for r in rows if r["id"] == 2)
    assert (bare["first_word"], bare["labels"], bare["score"]) == (None, "", 0.0)
    assert scan_licenses(no_docs).count() == 0


@pytest.mark.parametrize("expression, order, labels, freedom", [
    ("MIT", "mit", ["mit"], 1.0),
    ("GPL-2.0-only OR MIT", "gpl-2.0-only mit or", ["gpl-2.0-only", "mit"], 1.0),
    ("GPL-2.0-only AND MIT", "gpl-2.0-only mit and", ["gpl-2.0-only", "mit"], 0.4),
    ("MIT OR Apache-2.0 AND GPL-3.0+", "mit apache-2.0 gpl-3.0+ and or", ["apache-2.0", "gpl-3.0+", "mit"], 1.0),
    ("(MIT OR Apache-2.0) AND GPL-3.0", "mit apache-2.0 or gpl-3.0 and", ["apache-2.0", "gpl-3.0", "mit"], 0.4),
    ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", "gpl-2.0 classpath-exception-2.0 with mit and", ["gpl-2.0", "mit"], 0.7),
    ("MIT */", "mit", ["mit"], 1.0),
    ("MIT -->", "mit", ["mit"], 1.0),
])
def test_expressions(expression, order, labels, freedom):
    found = postfix(expression)
    assert " ".join(found) == order
    assert evaluate(found) == (labels, pytest.approx(freedom))


@pytest.mark.parametrize("expression", ["", "OR MIT", "MIT OR", "(MIT", "()", "MIT AND AND MIT", "*/"])
def test_unreadable_expressions(expression):
    with pytest.raises(ValueError):
        postfix(expression)


def test_tags_are_read_from_the_text():
    text = "// SPDX-License-Identifier: MIT OR GPL-2.0\nCode under the MIT license.\n# spdx-license-identifier: (oops"
    _, hits, expressions, score = scan_text(text.encode(), automaton())
    assert [found["labels"] for found in expressions] == [["gpl-2.0", "mit"]]
    assert score == 1.0 and [hit["label"] for hit in hits] == ["mit"]
