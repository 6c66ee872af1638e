"""The binary Golay code of 23 bits: nearest codewords and all codewords within four bits."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Generator polynomial of the perfect (23, 12) code. A fixed value.
_GENERATOR = 0b110001110101
_PARITY = 11


@lru_cache(maxsize=1)
def _tables():
    """Remainders of the high 12 bits, error patterns by syndrome, and the further codewords.

    The code is perfect: each of the 2,048 syndromes belongs to one error of at most three bits.
    A word three bits off its codeword has five more codewords at four bits, one for each codeword
    of weight seven that contains those three bits; nearer words have none.
    """
    remainder = np.zeros(1 << 12, np.int64)
    for high in range(1 << 12):
        word = high << _PARITY
        for bit in range(22, _PARITY - 1, -1):
            if word >> bit & 1:
                word ^= _GENERATOR << (bit - _PARITY)
        remainder[high] = word
    errors = np.zeros(1 << _PARITY, np.int64)
    weights = np.zeros(1 << _PARITY, np.int64)
    for size in range(4):
        for bits in combinations(range(23), size):
            error = sum(1 << b for b in bits)
            at = remainder[error >> _PARITY] ^ (error & 0x7FF)
            errors[at], weights[at] = error, size
    codewords = (np.arange(1 << 12) << _PARITY) | remainder
    sevens = [int(c) for c in codewords if int(c).bit_count() == 7]
    further: dict[int, list[int]] = {}
    for c in sevens:
        for bits in combinations([b for b in range(23) if c >> b & 1], 3):
            further.setdefault(sum(1 << b for b in bits), []).append(c)
    steps = np.zeros((1 << _PARITY, 5), np.int64)
    for at in np.flatnonzero(weights == 3):
        steps[at] = further[int(errors[at])]
    return remainder, errors, weights, steps


def nearest(words: np.ndarray) -> np.ndarray:
    """The index (12 bits) of the codeword within three bits of each 23-bit word."""
    remainder, errors, _, _ = _tables()
    words = words.astype(np.int64)
    return (words ^ errors[remainder[words >> _PARITY] ^ (words & 0x7FF)]) >> _PARITY


def within_four(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and codeword indices: all codewords within four bits, one or six for a word.

    Of two words that differ in one bit, the codeword nearest to either is in the list of both.
    """
    remainder, errors, weights, steps = _tables()
    words = words.astype(np.int64)
    at = remainder[words >> _PARITY] ^ (words & 0x7FF)
    first = words ^ errors[at]
    wide = np.flatnonzero(weights[at] == 3)
    more = first[wide, None] ^ steps[at[wide]]
    rows = np.concatenate([np.arange(len(words)), np.repeat(wide, 5)])
    return rows, np.concatenate([first, more.ravel()]) >> _PARITY
