"""An FM-index over arrays of symbols: suffix order, wavelet-tree ranks, backward search, sampled positions.

Everything works on whole numpy arrays: one step of a backward search moves all
patterns at once. Symbol 0 ends a segment; patterns hold symbols from 1 on and
so never cross segments.
"""

from __future__ import annotations

import numpy as np

#: Every so many positions of a segment keep their place in the text.
SAMPLE_EVERY = 8

_U = np.uint64


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order; comparison ends at a suffix's first 0, ties there go by position.

    Prefix doubling: after each round a position's rank is the first place of
    all suffixes that agree with it so far, and only those that still share a
    rank are sorted on.
    """
    n = len(text)
    if not n:
        return np.empty(0, dtype=np.int64)
    ends = np.flatnonzero(text == 0)
    symbols = text.astype(np.int64) + len(ends)
    symbols[ends] = np.arange(len(ends))
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[order] = _first_places(symbols[order])
    open_ = order[_shared(rank[order])]
    width = 1
    while len(open_):
        # A suffix shorter than the width ended at a 0 of its own rank, so it is no longer open.
        keys = (rank[open_] << 32) | rank[open_ + width]
        by_key = np.argsort(keys, kind="stable")
        open_, keys = open_[by_key], keys[by_key]
        old = rank[open_]
        rank[open_] = old + _first_places(keys) - _first_places(old)
        open_ = open_[_shared(rank[open_])]
        width *= 2
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


def _first_places(values: np.ndarray) -> np.ndarray:
    """For each element of a sorted array the index of the first equal one."""
    new = np.concatenate([[True], values[1:] != values[:-1]])
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


def _shared(values: np.ndarray) -> np.ndarray:
    """Which elements of a sorted array have an equal neighbour."""
    same = values[1:] == values[:-1]
    return np.concatenate([[False], same]) | np.concatenate([same, [False]])


class _Bits:
    """A bit vector of 64-bit words with the count of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        packed = np.packbits(bits, bitorder="little")
        padded[:len(packed)] = packed
        self.words = padded.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word = i >> 6
        mask = (_U(1) << (i & 63).astype(_U)) - _U(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(_U)) & _U(1)).astype(np.int64)


class WaveletTree:
    """Ranks and symbols of a sequence, one bit vector for each bit of the symbols, zeros moved before ones."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.levels = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (sequence >> shift) & 1 == 1
            self.levels.append((shift, _Bits(ones)))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        self.origin = self._move(np.arange(symbols), np.zeros(symbols, dtype=np.int64))

    def _move(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(i)
            i = np.where((symbol >> shift) & 1 == 1, bits.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each index."""
        return self._move(symbol, i) - self.origin[symbol]

    def get(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each index and its rank there."""
        symbol = np.zeros(len(i), dtype=np.int64)
        for shift, bits in self.levels:
            bit, ones = bits.get(i), bits.ones(i)
            symbol |= bit << shift
            i = np.where(bit == 1, bits.zeros + ones, i - ones)
        return symbol, i - self.origin[symbol]


class FmIndex:
    """Finds all places of patterns in a text whose segments each end with a 0; symbols are below `symbols`."""

    def __init__(self, text: np.ndarray, symbols: int, sample_every: int = SAMPLE_EVERY) -> None:
        text = text.astype(np.int64)
        suffixes = suffix_order(text)
        self.tree = WaveletTree(text[suffixes - 1], symbols)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        # A walk to the left must end before it leaves its segment, so the first place of each is sampled too.
        sampled = (suffixes % sample_every == 0) | (text[suffixes - 1] == 0)
        self.sampled = _Bits(sampled)
        self.places = suffixes[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges (begin, end) of patterns: rows of symbols, shorter ones filled with 0 on the left."""
        count, width = patterns.shape
        begin, end = np.zeros(count, dtype=np.int64), np.full(count, self.below[-1], dtype=np.int64)
        live = np.arange(count)
        for column in range(width - 1, -1, -1):
            symbol = patterns[live, column]
            live, symbol = live[symbol > 0], symbol[symbol > 0]  # a shorter pattern is done
            if not len(live):
                break
            begin[live] = self.below[symbol] + self.tree.rank(symbol, begin[live])
            end[live] = self.below[symbol] + self.tree.rank(symbol, end[live])
            live = live[begin[live] < end[live]]
        return begin, end

    def locate(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the range, place in the text) of every suffix in the ranges."""
        sizes = np.maximum(end - begin, 0)
        number = np.repeat(np.arange(len(begin)), sizes)
        row = np.repeat(begin - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(number))
        place, steps = np.zeros(len(row), dtype=np.int64), np.zeros(len(row), dtype=np.int64)
        walking = np.arange(len(row))
        while len(walking):
            there = self.sampled.get(row[walking]) == 1
            done = walking[there]
            place[done] = self.places[self.sampled.ones(row[done])] + steps[done]
            walking = walking[~there]
            symbol, rank = self.tree.get(row[walking])
            row[walking] = self.below[symbol] + rank
            steps[walking] += 1
        return number, place
