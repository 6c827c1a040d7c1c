"""Indexes over one block of short sequences: suffix array, Burrows-Wheeler transform, FM-index."""

from __future__ import annotations

import numpy as np


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; the first symbols are ranked together where they fit into one number.

    Prefix doubling that sorts only suffixes whose place is still open. The end sorts before every symbol.
    """
    n = len(values)
    if not n:
        return np.zeros(0, np.int64)
    wide = int(values.max() + 1).bit_length()
    depth = max(1, 62 // wide)
    key = np.zeros(n + depth, np.int64)
    key[:n] = values + 1
    first = key[:n].copy()
    for i in range(1, depth):
        first = (first << wide) | key[i:n + i]
    order = np.argsort(first, kind="stable")
    head = np.concatenate(([True], np.diff(first[order]) != 0))
    start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = start, -1
    while True:
        open_ = np.flatnonzero(~(head & np.concatenate((head[1:], [True]))))
        if not len(open_):
            return order
        at = order[open_]
        key = (start[open_] << 32) | (rank[np.minimum(at + depth, n)] + 1)
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[open_] = at
        head[open_] = fresh = np.concatenate(([True], np.diff(key) != 0))
        start[open_] = np.maximum.accumulate(np.where(fresh, open_, 0))
        rank[at] = start[open_]
        depth *= 2


def joined(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All sequences of symbols from 1 on, each followed by the separator 0; and where each begins.

    A string without a separator lies in one sequence wherever it occurs.
    """
    begins = np.concatenate(([0], np.cumsum([len(s) + 1 for s in sequences], dtype=np.int64)))
    text = np.zeros(begins[-1], np.int64)
    inside = np.ones(begins[-1], bool)
    inside[begins[1:] - 1] = False
    if sequences:
        text[inside] = np.concatenate(sequences)
    return text, begins


def starts_of_windows(begins: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows that lie in one sequence, and how many each sequence has."""
    counts = np.maximum(0, np.diff(begins) - 1 - window + 1)
    first = np.repeat(begins[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return first + np.arange(counts.sum()), counts


def repeated_by_intervals(text: np.ndarray, least: int) -> np.ndarray:
    """At which positions a string of `least` symbols starts that also starts elsewhere.

    Breadth-first backward extension: all intervals of strings of length 0, 1, 2, ... in the suffix array, each
    extended by every symbol before it in the Burrows-Wheeler transform. The first interval that ends at a row fixes
    the common prefix of that row and the next one: the length before the extension. So the values appear in
    increasing order; the search stops at `least`, and rows still open have a common prefix at least that long.
    """
    n = len(text)
    order = suffix_array(text)
    before = text[order - 1].astype(np.int16 if text.max(initial=0) < 1 << 15 else np.int64)
    step = np.empty(n, np.int32)
    step[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    one, low, high = np.zeros(0, np.int32), np.array([0]), np.array([n])
    for _ in range(least):
        # intervals of one row have one extension, of one row
        one = step[one]
        one = one[~known[one + 1]]
        known[one + 1] = True
        if len(low):
            sizes = high - low
            rows = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            owner = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
            to = step[rows]
            by = np.argsort(to)
            to, owner, symbol = to[by], owner[by], before[rows[by]]
            edge = np.flatnonzero((np.diff(to) != 1) | (np.diff(owner) != 0) | (np.diff(symbol) != 0))
            low = to[np.concatenate(([0], edge + 1))].astype(np.int64)
            high = to[np.concatenate((edge, [len(to) - 1]))].astype(np.int64) + 1
            new = ~known[high]
            low, high = low[new], high[new]
            known[high] = True
            single = high - low == 1
            one = np.concatenate((one, low[single].astype(np.int32)))
            low, high = low[~single], high[~single]
        elif not len(one):
            break
    out = np.zeros(n, bool)
    out[order[~known[:-1] | ~known[1:]]] = True
    return out


class WaveletMatrix:
    """Ranks of symbols in a sequence: one packed bit vector with block counts for each bit of the alphabet."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bits = ((values >> shift) & 1).astype(bool)
            padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
            padded[:len(bits)] = bits
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            self.levels.append((packed, counts, int(len(bits) - bits.sum())))
            values = np.concatenate((values[~bits], values[bits]))
        self._begins = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        shift = len(self.levels)
        for packed, counts, zeros in self.levels:
            shift -= 1
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            ones = counts[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbol, at) - self._begins[symbol]


class FMIndex:
    """Backward search over sequences of symbols 1..symbols-1, kept as a wavelet matrix of the transform."""

    def __init__(self, sequences: list[np.ndarray], symbols: int):
        self.text, self.begins = joined(sequences)
        self.order = suffix_array(self.text)
        self.counts = np.concatenate(([0], np.cumsum(np.bincount(self.text, minlength=symbols))))
        self.tree = WaveletMatrix(self.text[self.order - 1], symbols)

    def match(self, stream: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics, as far as `least`: of what ends before each place of a stream of symbols, the length
        of the longest part that the index holds (`least` stands for any longer one), and its interval of suffixes."""
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.text))
        length = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        for i in range(1, least + 1):
            live = live[ends[live] >= i]
            symbol = stream[ends[live] - i]
            a = self.counts[symbol] + self.tree.rank(symbol, low[live])
            b = self.counts[symbol] + self.tree.rank(symbol, high[live])
            held = (a < b) & (symbol > 0)
            live, a, b = live[held], a[held], b[held]
            low[live], high[live], length[live] = a, b, i
        return length, low, high
