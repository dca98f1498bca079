"""Word shingles as numbers, for the tasks' Python."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
# A cache that has grown to this many entries starts anew; results don't depend on it.
CACHE_WORDS = 500_000

_multipliers = np.random.default_rng(2024).integers(1, 2**63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words, A-Z lower-cased.

    Lower-casing and splitting bytes touches A-Z and the six ASCII blanks only.
    """
    words = (text or "").encode().lower().split()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words in order; a shorter sequence is one shingle, none gives none."""
    n = len(words)
    width = min(n, SHINGLE_WORDS)
    if not n:
        return words
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total += words[i : n - width + 1 + i] * _multipliers[i]
    return mixed(total)
