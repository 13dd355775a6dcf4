"""Simple-8b: runs of integers packed into 64-bit words, each led by a 4-bit selector.

A selector says how many values its word packs and in how many bits each.  Selector 0 is
the escape: the word holds no value itself, the next word is one value as it stands, for
values of more than 60 bits.  Packing is greedy, as many values as fit into each word.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the coding: values in a word and bits of each, by selector.
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 0


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each unsigned value takes; none for 0."""
    if not len(values) or values.max() < 1 << 53:  # exact as floating-point numbers
        return np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    bits = np.zeros(len(values), np.uint8)
    rest = values.astype(np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        high = rest >> np.uint64(step)
        more = high > 0
        bits[more] += step
        rest = np.where(more, high, rest)
    return bits + (rest > 0)


def choose(values: np.ndarray) -> np.ndarray:
    """For each position, the selector that packs most values from there on."""
    n = len(values)
    bits = bit_lengths(values)
    chosen = np.full(n, ESCAPE, np.uint8)
    chosen[bits <= 60] = len(COUNTS) - 1
    for selector in range(len(COUNTS) - 2, 0, -1):
        count = COUNTS[selector]
        if count > n:
            break
        fits = bits <= BITS[selector]
        if not fits.any():
            break
        wrong = np.concatenate(([0], np.cumsum(~fits, dtype=np.int32)))
        whole = wrong[count:] == wrong[:-count]
        chosen[: n - count + 1][whole] = selector
    return chosen


def encode(values: np.ndarray) -> np.ndarray:
    """Words of 64 bits for unsigned values."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    chosen = choose(values)
    steps = np.asarray(COUNTS)[chosen].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.asarray(starts)
    selectors = chosen[starts]
    escaped = selectors == ESCAPE
    places = np.arange(len(starts)) + np.concatenate(([0], np.cumsum(escaped)[:-1]))
    words = np.zeros(len(starts) + int(escaped.sum()), np.uint64)
    words[places] = selectors.astype(np.uint64) << np.uint64(60)
    words[places[escaped] + 1] = values[starts[escaped]]
    for selector in np.unique(selectors[~escaped]):
        own = selectors == selector
        count, bits = COUNTS[selector], BITS[selector]
        if not bits:
            continue
        first, word = starts[own], np.zeros(int(own.sum()), np.uint64)
        for i in range(count):
            word |= values[first + i] << np.uint64(i * bits)
        words[places[own]] |= word
    return words


def decode(words: np.ndarray) -> np.ndarray:
    """The values of packed words."""
    words = np.ascontiguousarray(words, np.uint64)
    if not len(words):
        return np.zeros(0, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    at = -1
    for place in np.flatnonzero(selectors == ESCAPE).tolist():
        if place != at:  # a raw word may itself begin with four zero bits
            at = place + 1
            raw[at] = True
    counts = np.asarray(COUNTS)[selectors]
    counts[raw] = 1
    counts[np.flatnonzero(raw) - 1] = 0
    starts = np.concatenate(([0], np.cumsum(counts)))
    values = np.zeros(starts[-1], np.uint64)
    values[starts[:-1][raw]] = words[raw]
    plain = ~raw & (selectors != ESCAPE)
    for selector in np.unique(selectors[plain]):
        own = plain & (selectors == selector)
        count, bits = COUNTS[selector], BITS[selector]
        if not bits:
            continue
        first, word, mask = starts[:-1][own], words[own], np.uint64((1 << bits) - 1)
        for i in range(count):
            values[first + i] = (word >> np.uint64(i * bits)) & mask
    return values
