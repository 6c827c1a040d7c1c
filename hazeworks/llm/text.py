"""Texts as NumPy arrays: UTF-8 buffers, words, and hashes of any part in constant time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, U), np.ones(1, U)]


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins (with the end last). Null counts as empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], column.type)
    array = array.cast(pa.large_string() if pa.types.is_string(array.type) else array.type).fill_null("")
    _, where, data = array.buffers()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, np.int64)[array.offset:array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the constants are those of the SplitMix64 finalizer)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2**64."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Hashed:
    """Polynomial hashes, modulo 2**64, of any part of a sequence."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        up, self._down = powers(n)
        self._sums = np.zeros(n + 1, U)
        np.cumsum((symbols.astype(U) + U(1)) * up[:n], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def grams(self, k: int) -> np.ndarray:
        """Of all parts of length k, in order; not mixed: their high bits are what is used."""
        n = len(self._sums) - k
        return (self._sums[k:] - self._sums[:n]) * self._down[:n] if n > 0 else np.zeros(0, U)


#: Bytes that part words: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes as lower case, A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def words(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each text's first word (with the count last).

    A word is a maximal run of bytes that do not part words, inside one text.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~parts[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Hashed(data).of(starts, ends)


def batches(offsets: np.ndarray, size: int = 1 << 17):
    """Ranges of texts of about `size` bytes together; a longer text is a range of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n places lie in [s, s + length) for some start s; the windows fit."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    steps = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
