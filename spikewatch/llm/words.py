"""Words of texts as 64-bit hashes, and hashes of word windows.

A word is a run of anything but ASCII white space. Word sequences are taken for equal when
their hashes are; the operators say how many bits they compare.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

# Words a task remembers. Beyond it the memory starts afresh; results do not change.
MOST_WORDS = 300_000
# Odd factors of the rolling hashes and of the final mixing.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Numbers(dict):
    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordHashes:
    """Hashes of words, remembering those met before."""

    def __init__(self):
        self.numbers, self.table = _Numbers(), np.zeros(0, np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > MOST_WORDS:
            self.numbers, self.table = _Numbers(), np.zeros(0, np.uint64)
        found = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        new, self.numbers.new = self.numbers.new, []
        if new:
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
            self.table = np.r_[self.table, hashes]
        return self.table[found]


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    """One memory per worker process."""
    return WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * MIX
    return values ^ (values >> np.uint64(29))


def window_hashes(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of the words at ``i, ..., i + size - 1`` for every ``i`` where they exist.

    A polynomial in an odd factor modulo 2^64, by prefix sums; ``which`` picks the factor.
    """
    if len(words) < size:
        return np.zeros(0, np.uint64)
    factor = FACTORS[which]
    powers = np.full(len(words) + 1, factor, np.uint64)
    inverse = np.full(len(words) + 1, pow(factor, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(inverse, out=inverse)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[:-1], out=sums[1:])
    last = len(words) - size + 1
    return mixed((sums[size:] - sums[:last]) * inverse[:last])
