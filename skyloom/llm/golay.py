"""The perfect binary Golay code of length 23: indices of the codewords near a 23-bit word.

Every word lies within three bits of exactly one codeword. ``keys`` of a word are the codewords of
all words at most one bit away: one codeword if the nearest is within two bits, else that one and
five more at distance four. Two words that differ in at most two bits have a word between them that
is one bit or less from both, so they share a key; of two that differ in one bit each has the
nearest codeword of the other among its keys.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

BITS, INFORMATION, CHECKS = 23, 12, 11
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
KEYS = 6


def remainder(word: int) -> int:
    """Remainder of the word, as a polynomial over two elements, by the generator."""
    for i in range(BITS - 1, CHECKS - 1, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - CHECKS)
    return word


@functools.lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the high parts of words, and for every remainder the patterns that lead to its keys.

    The first pattern is the only one of weight three or less; places without a further pattern
    repeat it.
    """
    high = np.array([remainder(i << CHECKS) for i in range(1 << INFORMATION)], np.int32)
    single = [remainder(1 << i) for i in range(BITS)]
    found: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    for weight in range(5):
        for places in combinations(range(BITS), weight):
            rest = 0
            for i in places:
                rest ^= single[i]
            mine = found[rest]
            # patterns of weight four count only beside a leader of weight three
            if weight < 4 or bin(mine[0]).count("1") == 3:
                mine.append(sum(1 << i for i in places))
    patterns = np.array([p + p[:1] * (KEYS - len(p)) for p in found], np.int32)
    return high, patterns


def keys(words: np.ndarray) -> np.ndarray:
    """Codeword indices (len(words), KEYS); the nearest codeword comes first, and stands in for missing ones."""
    high, patterns = tables()
    words = words.astype(np.int32)
    rest = high[words >> CHECKS] ^ (words & ((1 << CHECKS) - 1))
    return (words[:, None] ^ patterns[rest]) >> CHECKS
