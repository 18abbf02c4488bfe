"""Word shingles as 64-bit hashes in numpy, a text at a time."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words kept per Python worker; beyond, the cache starts anew.
CACHE = 100_000
_ODD, _MULTIPLY = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_HIGH, _LOW = np.uint64(31), np.uint64(27)


class WordHashes(dict):
    """Hash of a word, worked out on first use."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def mixed(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A hash of both, the order counts."""
    x = state * _ODD + value
    x = (x ^ (x >> _HIGH)) * _MULTIPLY
    return x ^ (x >> _LOW)


def word_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the words between ASCII white space, A-Z in lower case."""
    if len(_hashes) > CACHE:
        _hashes.clear()
    words = (text or b"").lower().split()
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """The sorted distinct k-word shingles; a shorter text is one, an empty one has none."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    width = min(k, len(hashes))
    n = len(hashes) - width + 1
    state = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        state = mixed(state, hashes[i : i + n])
    return np.unique(state)
