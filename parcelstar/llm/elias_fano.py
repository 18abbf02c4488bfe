"""Elias-Fano sequences over memory-mapped words, searched a whole array at a time.

n non-decreasing values below a universe are kept in about 2 + log2(universe / n) bits
each: the low bits packed side by side, the high bits as a run of ones and zeros. A value's
place is found with select over the ones, a value's successor with select over the zeros
and a binary search among the values with the same high bits.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BLOCK_WORDS = 8
_BLOCK_BITS = 64 * _BLOCK_WORDS
_HEAD = 5


def _packed(bits: np.ndarray) -> np.ndarray:
    """0/1 bytes as little-endian 64-bit words."""
    data = np.packbits(bits, bitorder="little")
    return np.concatenate([data, np.zeros(-len(data) % 8, np.uint8)]).view(U)


def encode(values: np.ndarray, universe: int) -> np.ndarray:
    """The words of a sequence of sorted values below `universe`."""
    n = len(values)
    values = values.astype(U)
    low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
    low = values & U((1 << low_bits) - 1)
    shifts = np.arange(low_bits, dtype=U)
    lows = [
        ((low[a : a + 65536, None] >> shifts) & U(1)).astype(np.uint8).ravel()
        for a in range(0, n, 65536)
    ]
    low_words = _packed(np.concatenate(lows)) if lows and low_bits else np.zeros(0, U)
    high = (values >> U(low_bits)).astype(np.int64)
    bits = np.zeros(n + (universe >> low_bits) + 2, np.uint8)
    bits[high + np.arange(n)] = 1
    bits = np.concatenate([bits, np.zeros(-len(bits) % _BLOCK_BITS, np.uint8)])
    ones = bits.reshape(-1, _BLOCK_BITS).sum(axis=1, dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(ones)]).astype(U)
    high_words = _packed(bits)
    head = np.array([n, low_bits, len(low_words) + 1, len(high_words), len(before)], dtype=U)
    return np.concatenate([head, low_words, np.zeros(1, U), high_words, before])


class EliasFano:
    """A view of encoded words, which may be a memory map; `length` words of it."""

    def __init__(self, words: np.ndarray) -> None:
        self.n, self.low_bits, low, high, blocks = (int(x) for x in words[:_HEAD])
        at = _HEAD
        self.lows = words[at : at + low]
        self.highs = words[at + low : at + low + high]
        self.before = words[at + low + high : at + low + high + blocks].view(np.int64)
        self.length = at + low + high + blocks
        self.zeros_before = np.arange(blocks, dtype=np.int64) * _BLOCK_BITS - self.before

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), U)
        place = i.astype(U) * U(self.low_bits)
        word, offset = (place >> U(6)).astype(np.int64), place & U(63)
        after = (self.lows[word + 1] << U(1)) << (U(63) - offset)
        return ((self.lows[word] >> offset) | after) & U((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th one (or zero, if `flip`), from 0."""
        block = np.searchsorted(before, k, side="right") - 1
        left = k - before[block]
        words = self.highs[(block * _BLOCK_WORDS)[:, None] + np.arange(_BLOCK_WORDS)]
        words = ~words if flip else words
        counts = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int16)
        skip = (counts <= left[:, None]).sum(axis=1)
        rows = np.arange(len(k))
        bits = words[rows, skip]
        left = left - np.where(skip > 0, counts[rows, skip - 1], 0)
        word = block * _BLOCK_WORDS + skip
        place = np.zeros(len(k), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(bits & U((1 << step) - 1)).astype(np.int64)
            on = left >= count
            left = np.where(on, left - count, left)
            place += np.where(on, step, 0)
            bits = np.where(on, bits >> U(step), bits)
        return word * 64 + place

    def _run(self, place: np.ndarray) -> np.ndarray:
        """How many ones follow one another from a place on; 64 stands for 64 or more."""
        word, offset = place >> 6, (place & 63).astype(U)
        after = self.highs[np.minimum(word + 1, len(self.highs) - 1)]
        window = (self.highs[word] >> offset) | ((after << U(1)) << (U(63) - offset))
        gap = ~window
        return np.bitwise_count((gap & (~gap + U(1))) - U(1)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        i = np.asarray(i, dtype=np.int64)
        high = (self._select(i, self.before, False) - i).astype(U)
        return (high << U(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value >= x (n if none), and whether it is x."""
        x = np.asarray(x, dtype=U)
        high = (x >> U(self.low_bits)).astype(np.int64)
        low = x & U((1 << self.low_bits) - 1)
        # The ones after the zero before are the values with these high bits.
        zero = np.where(
            high > 0, self._select(np.maximum(high - 1, 0), self.zeros_before, True), -1
        )
        start = zero - high + 1
        run = self._run(zero + 1)
        stop = start + run
        long = np.flatnonzero(run == 64)
        if len(long):
            stop[long] = self._select(high[long], self.zeros_before, True) - high[long]
        a, b = start, stop.copy()
        while True:
            on = np.flatnonzero(a < b)
            if not len(on):
                break
            middle = (a[on] + b[on]) // 2
            less = self._low(middle) < low[on]
            a[on] = np.where(less, middle + 1, a[on])
            b[on] = np.where(less, b[on], middle)
        found = a < stop
        if found.any():
            found[found] = self._low(a[found]) == low[found]
        return a, found
