"""Suffix-array deduplication: byte strings that occur again anywhere, by threshold-bounded interval expansion.

Method: each block of candidate contexts (see repeats) becomes one text; breadth-first backward extension on its
Burrows-Wheeler transform fixes common prefixes by increasing length and stops at the minimum length. Suffixes whose
common prefix is still open then start a repeated string (suffixes.repeated_by_intervals).

Cases: null text counts as empty; shorter texts than the minimum keep all; rows repeated with the same id are rows of
their own and so copies of each other; an empty table gives an empty result; other columns pass through
`remove_repeats(keep=...)` untouched and may have any name that does not begin with two underscores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hazeworks.llm import suffixes as sx
from hazeworks.llm import text as tx
from hazeworks.llm.repeats import _NEVER, Scheme, sha256, without_repeats

DIGEST = (T.StructType().add("doc_id", "long").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
          .add("kept_sha256", "string"))


#: Windows whose anchors have offsets in one class of this many share all but so many bytes.
_CLASS = 16


def alike(texts: list[np.ndarray], window: int, names: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int]]:
    """(sequence, first window, window after the last): windows that may repeat.

    Windows of a class, by the anchor's offset, have a core in common. One whose core nothing else with that anchor has
    cannot repeat.
    """
    hashed = tx.Hashed(np.concatenate(texts))
    sizes = np.array([len(t) for t in texts], np.int64)
    begin, count = np.cumsum(sizes) - sizes, sizes - window + 1
    lowest, highest = (places - count + 1) // _CLASS, places // _CLASS
    number = highest - lowest + 1
    owner = np.repeat(np.arange(len(texts)), number)
    kind = np.repeat(lowest - np.cumsum(number) + number, number) + np.arange(number.sum())
    anchor = (begin + places)[owner]
    first = np.maximum(anchor - kind * _CLASS - _CLASS + 1, begin[owner])  # of the windows of the class
    last = np.minimum(anchor - kind * _CLASS, (begin + count - 1)[owner])
    core = hashed.of(anchor - kind * _CLASS, anchor - kind * _CLASS - _CLASS + 1 + window)
    key = tx.mix(names[owner] ^ tx.mix(core + kind.astype(np.uint64)))
    _, same, many = np.unique(key, return_inverse=True, return_counts=True)
    out: list[list[int]] = []
    alive = np.flatnonzero(many[same] > 1)
    for i, x, y in sorted(zip(owner[alive].tolist(), (first - begin[owner])[alive].tolist(),
                              (last - begin[owner])[alive].tolist(), strict=True)):
        if out and out[-1][0] == i and out[-1][2] == x:
            out[-1][2] = y + 1
        else:
            out.append([i, x, y + 1])
    return [tuple(o) for o in out]


def compare_bytes(texts: list[np.ndarray], smallest: np.ndarray, window: int, names: np.ndarray,
                  places: np.ndarray) -> list[np.ndarray]:
    values = [np.full(len(t) - window + 1, _NEVER) for t in texts]
    pieces = alike(texts, window, names, places)
    if pieces:
        text, begins = sx.joined([texts[i][x:y + window - 1].astype(np.int64) + 1 for i, x, y in pieces])
        hit = sx.repeated_by_intervals(text, window)
        for (i, x, y), b in zip(pieces, begins, strict=False):
            values[i][x:y][hit[b:b + y - x]] = np.iinfo(np.int64).min
    return values


def scheme(min_bytes: int) -> Scheme:
    return Scheme(min_bytes, max(1, min_bytes * 4 // 25), False, False, compare_bytes)


def repeated_bytes(docs: DataFrame, min_bytes: int = 200, home_bytes: int = 8 << 20) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans (maximal removed runs) and the SHA-256 of what is left."""

    def describe(table, found):
        rows = []
        ids = table["doc_id"].to_pylist()
        for part, gone in found:
            mask = tx.covered(len(part.data), gone, min_bytes)
            for i, (x, y) in enumerate(zip(part.offsets[:-1], part.offsets[1:], strict=True)):
                own = mask[x:y]
                rows.append((ids[part.first + i], int(y - x), int(own.sum()), len(tx.runs(own)[0]),
                             sha256(part.data[x:y][~own].tobytes())))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=DIGEST.names)

    return without_repeats(docs.select("doc_id", "text"), scheme(min_bytes), describe, DIGEST, home_bytes)


def without_repeated_bytes(docs: DataFrame, min_bytes: int = 200, home_bytes: int = 8 << 20) -> DataFrame:
    """The documents, all columns, with repeated strings cut out of their texts; characters cut in part stay whole."""

    names = docs.columns

    def describe(table, found):
        texts: list[str | None] = table["text"].to_pylist()
        for part, gone in found:
            mask = tx.covered(len(part.data), gone, min_bytes)
            head = (part.data & 0xC0) != 0x80  # first bytes of characters
            whole = np.logical_and.reduceat(mask, np.flatnonzero(head)) if len(mask) else mask
            mask = whole[np.cumsum(head) - 1] if len(mask) else mask
            for i, (x, y) in enumerate(zip(part.offsets[:-1], part.offsets[1:], strict=True)):
                own = mask[x:y]
                if own.any():
                    texts[part.first + i] = part.data[x:y][~own].tobytes().decode("utf-8")
        at = table.schema.get_field_index("text")
        return table.set_column(at, "text", pa.array(texts, table.schema.field("text").type)).select(names)

    return without_repeats(docs, scheme(min_bytes), describe, docs.schema, home_bytes)
