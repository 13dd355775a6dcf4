"""Licence scan: notice phrases and identifier tags by Aho-Corasick, expressions by
shunting-yard.

One automaton holds all notice phrases and the identifier tag, each a run of whole words,
and passes once over a text's words.  Where the tag occurs, the expression behind it is read
from the text itself, ordered by a shunting-yard parser (``WITH`` binds before ``AND``,
``AND`` before ``OR``) and evaluated: the labels of all its licences, and how free the use
is, where ``OR`` grants the freer side, ``AND`` the stricter, and an exception lifts a
copyleft licence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import small_batches, worker_state
from trackmill.llm.words import WordCounter, word_stream

# Phrases with their labels, as the scan's contract names them.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices that the scan knows beside them.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}

TAG = "spdx license identifier"
TAGGED = re.compile(r"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(r"\s*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+-]*(?::[A-Za-z0-9.+-]+)?))")

# How free a licence's use is, by the beginning of its identifier; others count 0.5.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "unlicense": 1.0, "cc0": 1.0,
    "0bsd": 1.0, "cc-by-nc": 0.2, "cc-by-nd": 0.2, "cc-by-sa": 0.6, "cc-by": 0.9, "mpl": 0.7,
    "lgpl": 0.7, "epl": 0.7, "agpl": 0.3, "gpl": 0.4, "proprietary": 0.0,
}
EXCEPTION_LIFT = 0.3
BINDS = {"or": 1, "and": 2, "with": 3}

# How sure each kind of evidence makes of a licence.
TAG_SCORE, BASE_SCORE, NOTICE_SCORE = 1.0, 0.9, 0.7

SCANNED = (
    "id long, n_words long, hits array<struct<start:long,label:string,base:boolean>>, "
    "expressions array<struct<text:string,postfix:string,labels:array<string>,freedom:double>>, score double"
)


def freedom_of(licence: str) -> float:
    fitting = [name for name in FREEDOM if licence.startswith(name)]
    return FREEDOM[max(fitting, key=len)] if fitting else 0.5


def postfix(expression: str) -> list[str]:
    """Operands and operators in postfix order; raises ``ValueError`` for no expression.

    What follows a complete expression, such as the end of a comment, is ignored.
    """
    out: list[str] = []
    waiting: list[str] = []
    at, operand_next = 0, True
    while found := TOKEN.match(expression, at):
        bracket, name = found.groups()
        low = (name or "").lower()
        if bracket == "(" and operand_next:
            waiting.append("(")
        elif bracket == ")" and not operand_next and "(" in waiting:
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif name and low not in BINDS and operand_next:
            out.append(low)
            operand_next = False
        elif low in BINDS and not operand_next:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand_next = True
        elif not operand_next and "(" not in waiting:
            break  # the line goes on with other words
        else:
            raise ValueError(f"misplaced {found[0].strip()!r}")
        at = found.end()
    if operand_next or "(" in waiting:
        raise ValueError("the expression is not complete")
    return out + waiting[::-1]


def evaluate(order: list[str]) -> tuple[list[str], float]:
    """Licence labels of a postfix expression, and the freedom it grants."""
    stack: list[tuple[set[str], float]] = []
    for token in order:
        if token not in BINDS:
            stack.append(({token}, freedom_of(token)))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":  # the right side names an exception, not a licence
            stack.append((left[0], min(1.0, left[1] + EXCEPTION_LIFT)))
        else:
            choose = max if token == "or" else min
            stack.append((left[0] | right[0], choose(left[1], right[1])))
    labels, freedom = stack.pop()
    return sorted(labels), freedom


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrases, base in ((NOTICES, False), (BASE_PHRASES, True)):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (len(phrase) + 2, label, base))
    found.add_word(f" {TAG} ", (len(TAG) + 2, None, False))
    found.make_automaton()
    return found


def scan_text(text: bytes, machine: ahocorasick.Automaton) -> tuple[int, list, list, float]:
    """Words, hits, expressions and score of one text."""
    n_words, stream = word_stream(text)
    counter, hits, expressions, tagged = WordCounter(stream), [], [], False
    for end, (length, label, base) in machine.iter(stream):
        if label is None:
            tagged = True
        else:
            hits.append({"start": counter.index(end - length + 1), "label": label, "base": base})
    for found in TAGGED.findall(text.decode()) if tagged else ():
        try:
            order = postfix(found)
        except ValueError:
            continue
        labels, freedom = evaluate(order)
        expressions.append(
            {"text": found.strip(), "postfix": " ".join(order), "labels": labels, "freedom": freedom}
        )
    evidence = [BASE_SCORE if hit["base"] else NOTICE_SCORE for hit in hits]
    score = TAG_SCORE if expressions else max(evidence, default=0.0)
    return n_words, hits, expressions, score


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine = worker_state("license_automaton", automaton)
    hit = pa.struct([("start", pa.int64()), ("label", pa.string()), ("base", pa.bool_())])
    expression = pa.struct([
        ("text", pa.string()), ("postfix", pa.string()), ("labels", pa.list_(pa.string())), ("freedom", pa.float64()),
    ])
    kinds = [pa.int64(), pa.list_(hit), pa.list_(expression), pa.float64()]
    for batch in batches:
        rows = [scan_text(text or b"", machine) for text in batch.column(1).cast(pa.binary()).to_pylist()]
        columns = zip(*rows, strict=True) if rows else [[], [], [], []]
        arrays = [pa.array(list(values), kind) for values, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *arrays], names=["id", "n_words", "hits", "expressions", "score"]
        )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row, whatever it holds: ``id``, ``n_words``, ``hits`` (every place of
    every phrase, with its first word counted from 0), ``expressions`` (every readable one
    behind an identifier tag) and ``score`` (0 without evidence, 1 with a readable tag).

    Absent and empty texts have no words and no hits; overlapping phrases all count;
    repeated rows are repeated; unreadable expressions are left out.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(_scan, SCANNED)


def licence_summary(scanned: DataFrame) -> DataFrame:
    """Scan results as one flat row per document."""
    base = F.filter("hits", lambda hit: hit["base"])
    starts = F.transform(base, lambda hit: hit["start"])
    own = F.flatten(F.transform("expressions", lambda found: found["labels"]))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return scanned.select(
        "id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.transform(base, lambda hit: hit["label"])).alias("base_labels"),
        joined(F.concat(F.transform("hits", lambda hit: hit["label"]), own)).alias("labels"),
        "score",
        F.transform("expressions", lambda found: found["text"]).alias("expressions"),
        F.array_min(F.transform("expressions", lambda found: found["freedom"])).alias("freedom"),
    )
