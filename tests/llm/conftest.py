from __future__ import annotations

import pytest

# Rows that every operator on documents must take: absent values in any column, empty and
# very long texts, ties and repeated rows, and columns whose names operators use themselves.
ODD = [
    (0, "Under the MIT license, he said.", "en", "a"),
    (1, "UNDER THE mit LICENSE, he said.", "en", "a"),
    (2, "", "en", "b"),
    (3, None, None, None),
    (3, None, None, None),
    (4, "word " * 30_000, "de", "a"),
    (None, "a text without an identifier", "fr", None),
    (None, None, None, "b"),
    (5, "Grüße, ÄPFEL und 中文 \U0001f600 \t\n  x", "de", "b"),
    (6, " \n\t ", "en", "c"),
    (6, "another text of a repeated identifier", "en", "c"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(*row, "clash", i, 1.5, "x") for i, row in enumerate(ODD)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, id string, row long, size double, kept string"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
