"""Words of a text: runs of digits, of letters ``a``-``z`` and of anything beyond ASCII."""

from __future__ import annotations

from trackmill.llm.common import UPPER

# Bytes of UTF-8 text: A-Z become a-z, other ASCII than letters and digits a blank;
# bytes of longer characters stay.
WORD_BYTES = bytes(
    ord(chr(b).lower()) if chr(b) in UPPER
    else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A
    else 0x20
    for b in range(256)
)


def word_stream(text: bytes) -> tuple[int, str]:
    """Number of words, and the words in lower case, each between two single blanks."""
    words = text.translate(WORD_BYTES).split()
    if not words:
        return 0, " "
    return len(words), " " + b" ".join(words).decode() + " "


class WordCounter:
    """Word index of rising positions in a word stream, counted once from left to right."""

    def __init__(self, stream: str) -> None:
        self.stream, self.at, self.count = stream, 0, 0

    def index(self, position: int) -> int:
        """Words that begin before the blank at ``position``; positions may also fall back."""
        if position < self.at:
            self.count -= self.stream.count(" ", position, self.at)
        else:
            self.count += self.stream.count(" ", self.at, position)
        self.at = position
        return self.count
