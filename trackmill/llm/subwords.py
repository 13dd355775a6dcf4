"""Subword ids of texts by a public byte-level BPE tokenizer, each distinct word once.

The tokenizer splits a text in front of every single blank or line end that a visible
character follows, and between a letter and a mark, and ids never reach across a split.  So a
worker encodes each distinct word from one blank or line end to the next once, with the
library, and keeps its ids; a text's ids are those of its words in turn.  Texts with
white space beside white space are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from itertools import chain, compress, repeat
from operator import is_

import numpy as np

from trackmill.llm.common import worker_state

VOCABULARY = "byte_bpe_50k.json"
# Words that a worker keeps; with more it starts anew.
KEPT = 1_200_000
# New words that are encoded as one text; the library takes longer over long ones.
TOGETHER = 200
# White space that is followed by other white space or ends the text.
ODD_BLANK = re.compile(r"\s(?:\s|\Z)")
MARKS = ".,"


def load(vocabulary: str = VOCABULARY):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


class Subwords:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        self.tokenizer = load(vocabulary)
        self.known: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}
        vocabulary_ids = self.tokenizer.get_vocab()
        # A token of a byte-level vocabulary is written with one character per byte.
        self.token_bytes = np.zeros(max(vocabulary_ids.values()) + 1, np.int64)
        for token, number in vocabulary_ids.items():
            self.token_bytes[number] = len(token)
        self.marks = {mark: self._whole(mark) for mark in MARKS}

    def _learn(self, words: list[str]) -> None:
        """Learn new words, those that end in a mark from the word before it."""
        if len(self.known) + len(words) > KEPT:
            self.known.clear()
        marked = [w for w in words if w[-1] in MARKS and w[-2:-1].isalpha()]
        plain = dict.fromkeys(w[:-1] for w in marked)
        plain.update(dict.fromkeys(w for w in words if not (w[-1] in MARKS and w[-2:-1].isalpha())))
        self._encode_new([w for w in plain if w not in self.known])
        for word in marked:
            self.known[word] = self.known[word[:-1]] + self.marks[word[-1]]

    def _encode_new(self, words: list[str]) -> None:
        """Encode words as texts of ``TOGETHER`` words, each behind its blank or line end, and cut
        their ids where a word's bytes end."""
        for start in range(0, len(words), 20_000):
            some = words[start:start + 20_000]
            spelt = [word if word[0] == "\n" else " " + word for word in some]
            texts = ["".join(spelt[at:at + TOGETHER]) for at in range(0, len(spelt), TOGETHER)]
            ids = np.array(list(chain.from_iterable(text.ids for text in self._library(texts))), "<u4")
            ends = np.cumsum([len(word.encode()) + (word[0] != "\n") for word in some])
            cuts = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1
            raw, last = ids.tobytes(), 0
            for word, cut in zip(some, cuts.tolist(), strict=True):
                self.known[word] = raw[4 * last:4 * cut]
                last = cut

    def _library(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; what no text of the list has shown before is learnt at once.

        A word stands for itself behind a blank, or begins with the line end before it."""
        split: list[tuple[str, list[str], list[bytes | None]] | None] = []
        new: dict[str, None] = {}
        get = self.known.get
        for text in texts:
            if not text or text[0].isspace() or ODD_BLANK.search(text):
                split.append(None)
                continue
            first, *words = text.replace("\n", " \n").split(" ")
            found = list(map(get, words))
            if None in found:
                new.update(dict.fromkeys(compress(words, map(is_, found, repeat(None)))))
            split.append((first, words, found))
        if new:
            self._learn(list(new))
        known, out = self.known, []
        for text, parts in zip(texts, split, strict=True):
            if parts is None:
                out.append(self._whole(text))
                continue
            first, words, found = parts
            try:
                ids = b"".join(map(known.__getitem__, words) if None in found else found)
            except KeyError:  # forgotten to make room
                out.append(self._whole(text))
                continue
            out.append(self._first(first) + ids)
        return out

    def _first(self, word: str) -> bytes:
        found = self.firsts.get(word)
        if found is None:
            if len(self.firsts) >= KEPT // 10:
                self.firsts.clear()
            found = self.firsts[word] = self._whole(word)
        return found

    def _whole(self, text: str) -> bytes:
        return np.array(self._library([text])[0].ids, "<u4").tobytes() if text else b""


def worker_subwords(vocabulary: str = VOCABULARY, make: Callable[..., Subwords] = Subwords) -> Subwords:
    return worker_state(f"subwords_{vocabulary}_{make.__name__}", lambda: make(vocabulary))
