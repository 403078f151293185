"""A compressed full-text index over sequences of words, for matches up to a given length."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a running count per 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many bits are set before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Counts symbols before a place with a rank per bit of the symbol."""

    def __init__(self, symbols: np.ndarray, distinct: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        for shift in reversed(range(max(1, int(distinct - 1).bit_length()))):
            bits = (symbols >> shift) & 1 == 1
            self.levels.append((shift, BitVector(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        self.begin = self._descend(np.arange(distinct), np.zeros(distinct, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._descend(symbol, at) - self.begin[symbol]


class FMIndex:
    """Over ``text``, symbols from 1 up and 0 as a separator, which must be its last and which no
    query may hold. Suffixes are sorted by their first ``cap`` symbols, which is all that matches of
    at most ``cap`` symbols need."""

    def __init__(self, text: np.ndarray, cap: int):
        self.cap, n = cap, len(text)
        rank, length = text.astype(np.int64) + 1, 1
        while length < cap:
            step = min(length, cap - length)
            tail = np.zeros(n, np.int64)
            tail[: max(0, n - step)] = rank[step:]
            rank = 1 + np.unique(rank * (n + 2) + tail, return_inverse=True)[1].astype(np.int64)
            length += step
        self.suffixes = np.argsort(rank, kind="stable")
        distinct = int(text.max(initial=0)) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=distinct))])
        self.last = WaveletMatrix(text[self.suffixes - 1], distinct)  # a row's symbol is that before its suffix
        padded = np.concatenate([text, np.full(cap, -1, text.dtype)])
        self.common = np.zeros(n + 1, np.int8)  # symbols that a row's suffix shares with the row above
        alike = np.flatnonzero(np.ones(max(0, n - 1), bool))
        for k in range(cap):
            alike = alike[padded[self.suffixes[alike] + k] == padded[self.suffixes[alike + 1] + k]]
            self.common[alike + 1] = k + 1
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def blocks(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(block of each row, first row of each block and the end): rows of a block share ``length`` symbols."""
        if length not in self._blocks:
            new = self.common[:-1] < length
            new[:1] = True
            self._blocks[length] = np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(new))
        return self._blocks[length]

    def widened(self, low: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows that share their first ``length`` symbols with row ``low``."""
        block, begin = self.blocks(length)
        return begin[block[low]], begin[block[low] + 1]

    def extended(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the rows of ``symbol`` followed by what the rows low .. high begin with."""
        both = self.last.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.first[symbol] + both[: len(low)], self.first[symbol] + both[len(low) :]

    def matching_statistics(self, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place of the queries, which lie one after another: the length (up to ``cap``) of
        the longest match that starts there, and the rows low .. high of its occurrences.

        All queries are searched at once, from their ends. Symbols that the text lacks may be any.
        """
        ends = np.cumsum(sizes)
        by_size = np.argsort(-sizes, kind="stable")
        low, high, length = (np.zeros(len(sizes), np.int64) for _ in range(3))
        high[:] = len(self.suffixes)
        found = np.zeros((3, len(queries)), np.int64)
        for step in range(int(sizes.max(initial=0))):
            active = by_size[: int((sizes > step).sum())]
            place = ends[active] - 1 - step
            symbol = queries[place]
            known = (symbol > 0) & (symbol < len(self.first) - 1)
            full = active[length[active] == self.cap]
            low[full], high[full] = self.widened(low[full], self.cap - 1)
            length[full] -= 1
            todo = np.flatnonzero(known)
            while len(todo):
                q, s = active[todo], symbol[todo]
                a, b = self.extended(low[q], high[q], s)
                good = a < b
                low[q[good]], high[q[good]] = a[good], b[good]
                length[q[good]] += 1
                todo = todo[~good]
                q = active[todo]
                shorter = length[q] > 0
                todo = todo[shorter]
                q = q[shorter]
                for m in np.unique(length[q]):  # shorten the match by one at its end and try again
                    same = q[length[q] == m]
                    low[same], high[same] = self.widened(low[same], m - 1)
                length[q] -= 1
            unknown = active[~known]
            low[unknown], high[unknown], length[unknown] = 0, len(self.suffixes), 0
            found[:, place] = length[active], low[active], high[active]
        return found[0], found[1], found[2]
