"""The binary Golay code of 23 bits: 12 bits of index, and every word at most 3 bits from exactly one codeword.

Around a word lie, at most 4 bits away, either one codeword (the word is at most 2 bits from it) or six (one 3 bits away,
five 4 bits away). Two words that differ in at most 2 bits have such a codeword in common: one that is at most 3 bits
from the word between them. So the indices of these codewords are keys that 2 bit errors cannot separate.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS = 23
INDEX_BITS = 12
KEYS = 6
_CHECK_BITS = BITS - INDEX_BITS
# Fixed value: the generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
_GENERATOR = 0b110001110101


@cache
def _single_syndromes() -> np.ndarray:
    """Remainder of each single bit by the generator."""
    rest, out = 1, []
    for _ in range(BITS):
        out.append(rest)
        rest <<= 1
        if rest >> _CHECK_BITS:
            rest ^= _GENERATOR
    return np.array(out, np.int64)


def _syndrome(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), np.int64)
    for bit, rest in enumerate(_single_syndromes()):
        out ^= ((words >> bit) & 1) * rest
    return out


@cache
def _errors() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: up to six errors of at most 4 bits that lead to a codeword, and how many there are."""
    patterns = np.array([sum(1 << b for b in bits) for n in range(5) for bits in combinations(range(BITS), n)], np.int64)
    syndromes = _syndrome(patterns)
    order = np.argsort(syndromes, kind="stable")
    patterns, syndromes = patterns[order], syndromes[order]
    counts = np.bincount(syndromes, minlength=1 << _CHECK_BITS)
    table = np.zeros((1 << _CHECK_BITS, KEYS), np.int64)
    table[syndromes, np.arange(len(patterns)) - np.repeat(np.cumsum(counts) - counts, counts)] = patterns
    return table, counts


def nearby_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords at most 4 bits from each word, in six columns, and how many of them count."""
    words = words.astype(np.int64)
    table, counts = _errors()
    syndromes = _syndrome(words)
    return (words[:, None] ^ table[syndromes]) >> _CHECK_BITS, counts[syndromes]
