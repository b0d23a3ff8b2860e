"""The perfect binary Golay code of length 23: every 23-bit word is within 3 bits of one codeword."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainder of each single bit; per remainder the error patterns of up to 4 bits, the
    lightest first, padded with the lightest; and how many different ones there are."""
    bits = np.array([_remainder(1 << b) for b in range(LENGTH)], np.int64)
    found: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    for weight in range(5):
        for chosen in combinations(range(LENGTH), weight):
            rest = 0
            for b in chosen:
                rest ^= int(bits[b])
            if weight < 4 or found[rest] and found[rest][0].bit_count() == 3:
                found[rest].append(sum(1 << b for b in chosen))
    most = max(map(len, found))
    errors = np.array([e + e[:1] * (most - len(e)) for e in found], np.int64)
    return bits, errors, np.array(list(map(len, found)))


def remainders(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), np.int64)
    for b, rest in enumerate(tables()[0]):
        out ^= np.where(words >> b & 1, rest, 0)
    return out


def own_index(words: np.ndarray) -> np.ndarray:
    """The index (the 12 leading bits) of the codeword within 3 bits of each word."""
    return (words ^ tables()[1][remainders(words), 0]) >> CHECKS


def near_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords within 4 bits where the nearest is 3 away, else of the nearest
    one: an array with a row per word, and how many of its leading entries count.

    A word one bit away decodes to one of these: it lies within 3 bits of its codeword, so that
    codeword is within 4 bits of this word; if the nearest is at most 2 away, it is the same.
    """
    _, errors, numbers = tables()
    rest = remainders(words)
    return (words[:, None] ^ errors[rest]) >> CHECKS, numbers[rest]
