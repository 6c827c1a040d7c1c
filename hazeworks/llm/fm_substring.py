"""Substring deduplication over words: FM-index per shard, matching statistics of streamed text.

Method: a shard (see repeats: the contexts under a range of anchors) is kept as an FM-index, a wavelet matrix over the
Burrows-Wheeler transform of its words. The words of contexts are streamed against it by backward search; where the
matching statistics reach the window length, the interval of suffixes names all documents that have the window, and
the smallest of them decides. Maximal runs of covered words are the reported intervals.

A word is removed if a window of `window` words covers it that also starts in a document with a smaller id. Windows
are judged on the input. Of documents with the same id (repeated rows) none is smaller, so they keep what only they
share. Null texts have no words; a null id is larger than any other and so removes nothing from others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hazeworks.llm import text as tx
from hazeworks.llm.repeats import _NEVER, Scheme, sha256, without_repeats
from hazeworks.llm.suffixes import FMIndex

DIGEST = (T.StructType().add("doc_id", "long").add("n_words", "long").add("n_removed", "long")
          .add("kept_sha256", "string").add("spans", T.ArrayType(T.ArrayType(T.LongType()))))


def compare_words(texts: list[np.ndarray], smallest: np.ndarray, window: int, names: np.ndarray,
                  places: np.ndarray) -> list[np.ndarray]:
    data = np.concatenate(texts)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    starts, ends, bounds = tx.words(data, offsets)
    _, words = np.unique(tx.word_hashes(data, starts, ends), return_inverse=True)
    symbols = int(words.max(initial=0)) + 2
    index = FMIndex(np.split(words + 1, bounds[1:-1]), symbols)
    counts = np.maximum(0, np.diff(bounds) - window + 1)
    start = np.repeat(bounds[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    length, low, high = index.match(words + 1, start + window, window)
    reached = length == window
    owner = np.append(smallest[np.searchsorted(index.begins, index.order, "right") - 1], _NEVER)
    least = np.full(len(start), _NEVER)
    if reached.any():
        least[reached] = np.minimum.reduceat(owner, np.stack((low[reached], high[reached]), 1).reshape(-1))[::2]
    return np.split(least, np.cumsum(counts)[:-1])


def scheme(window: int) -> Scheme:
    return Scheme(window, max(1, window * 2 // 5), True, True, compare_words)


def repeated_words(docs: DataFrame, window: int = 13, home_bytes: int = 8 << 20) -> DataFrame:
    """Per document: n_words, n_removed, the SHA-256 of the kept words joined by one space, and the removed spans
    (first word, word after the last)."""

    def describe(table, found):
        ids, rows = table["doc_id"].to_pylist(), []
        for part, gone in found:
            mask = tx.covered(len(part.starts), gone, window)
            data = part.data.tobytes()
            for i, (x, y) in enumerate(zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist(), strict=True)):
                stay = np.flatnonzero(~mask[x:y]) + x
                kept = [data[a:b] for a, b in zip(part.starts[stay].tolist(), part.ends[stay].tolist(), strict=True)]
                spans = [[int(a), int(b)] for a, b in zip(*tx.runs(mask[x:y]), strict=True)]
                rows.append((ids[part.first + i], y - x, y - x - len(kept), sha256(b" ".join(kept)), spans))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))
        columns = zip(*rows, strict=True)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=DIGEST.names)

    return without_repeats(docs.select("doc_id", "text"), scheme(window), describe, DIGEST, home_bytes)
