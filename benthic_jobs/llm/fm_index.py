"""A compressed full-text index of word sequences: a wavelet matrix over the Burrows-Wheeler transform.

The suffixes are sorted by their first ``order`` symbols, which is exact for patterns up to that length.
Each level of the matrix is a packed bit vector with a count for every 64 bits. The suffixes of texts with a weight are
one more such vector, and only those have a number of their own. Searches run for many patterns at once; a step reads
every level twice, whatever the index holds.
"""

from __future__ import annotations

import numpy as np

_LOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class _Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.before = np.concatenate([[0], counts[:-1]])
        self.zeros = len(bits) - int(counts[-1])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """How many ones stand before each position."""
        block = i >> 6
        return self.before[block] + np.bitwise_count(self.words[block] & _LOW[i & 63])


class FMIndex:
    """Counts of patterns in texts; a text's occurrences weigh ``weights[text]``."""

    def __init__(self, symbols: np.ndarray, text_of: np.ndarray, weights: np.ndarray, order: int) -> None:
        """``symbols``: the texts one after the other, each ended by a 0; other symbols are 1 and above."""
        n = len(symbols)
        rank, span = symbols.astype(np.int64), 1
        while span < order:  # prefix doubling
            ahead = np.zeros(n, np.int64)
            ahead[: n - span] = rank[span:] + 1
            rank = np.unique(rank * (int(ahead.max()) + 1) + ahead, return_inverse=True)[1]
            span *= 2
        suffixes = np.argsort(rank, kind="stable")
        last = symbols[suffixes - 1]
        weight = weights[text_of[suffixes]]
        self.heavy = _Bits(weight > 1)
        self.excess = np.concatenate([[0], np.cumsum(weight[weight > 1] - 1)])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=int(symbols.max()) + 1))])
        self.n = n
        self.levels: list[tuple[int, _Bits]] = []
        for shift in range(int(symbols.max()).bit_length() - 1, -1, -1):
            bit = (last >> shift) & 1
            self.levels.append((shift, _Bits(bit)))
            last = np.concatenate([last[bit == 0], last[bit == 1]])

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the intervals of ``symbol`` followed by what ``[low, high)`` stood for."""
        start = np.zeros_like(low)
        for shift, bits in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b, s = bits.ones(low), bits.ones(high), bits.ones(start)
            low = np.where(one, bits.zeros + a, low - a)
            high = np.where(one, bits.zeros + b, high - b)
            start = np.where(one, bits.zeros + s, start - s)
        begin = self.first[symbol]
        return begin + low - start, begin + high - start

    def weight(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The weight of the suffixes [low, high)."""
        return high - low + self.excess[self.heavy.ones(high)] - self.excess[self.heavy.ones(low)]

    def matching(self, symbols: np.ndarray, ends: np.ndarray, most: int, least_weight: int) -> np.ndarray:
        """Matching statistics: the longest suffix of ``symbols[:end]``, up to ``most``, that weighs enough."""
        length = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64)
        for step in range(1, most + 1):
            symbol = symbols[ends[live] - step]
            low, high = self.extend(symbol, low, high)
            good = (symbol > 0) & (self.weight(low, high) >= least_weight)
            live, low, high = live[good], low[good], high[good]
            length[live] = step
            if not len(live):
                break
        return length
