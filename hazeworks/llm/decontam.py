"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and anything beyond ASCII, lower-cased (A-Z). Every n-gram of a benchmark item is a
seed. Documents with a seed of an item are aligned with that item around the seeds, in words: match 2, mismatch -1,
gap -1. The score is the best local alignment's, divided by that of an exact copy. A document holds an item if the score
is `least` or more, or if it has `verbatim` words in a row of the item, whose share of a long item may be small.

Rarity of a seed, the number of items that have it, sets the order: candidates with a rare seed are aligned first, so that
a document that is to go is mostly decided by them. No seed is left out. Before the alignment, a candidate has to have
enough of the item's words, first in the document and then where the alignment would be: a score of `least` needs that
share of them, so nothing is lost, while common seeds alone cost a look at the words. Seeds' places in the items are
looked up for a bounded number at a time, however common a seed is.

Alignments without n equal words in a row (every third word replaced) have no seed and are not found.

The benchmark is sent to all tasks in blocks of `block_words` words at most (or one item, if that is longer); a larger
benchmark takes more passes over the documents. Documents are never moved, whatever their number of copies.

Cases: null and empty texts or items match nothing, nor do items of fewer than n words; a null item_id is -1;
repeated rows are reported each; a null doc_id is reported as null; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.llm import text as tx

MATCHES = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint, n_item_words bigint"
_PARTS = np.ones(256, bool)
_PARTS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def word_values(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the index of each text's first word (with the count last)."""
    starts, ends, bounds = tx.words(data, offsets, _PARTS)
    return tx.word_hashes(tx.LOWER[data], starts, ends), bounds


def gram_values(words: np.ndarray, n: int) -> np.ndarray:
    return tx.mix(tx.Hashed(words).grams(n))


@dataclass
class Items:
    ids: np.ndarray
    words: np.ndarray
    bounds: np.ndarray
    n: int
    #: All n-grams: sorted distinct values; and, per n-gram of an item, value's index, item and place.
    names: np.ndarray
    of: np.ndarray
    item: np.ndarray
    place: np.ndarray
    #: The n-grams ordered by `of`, and where those of each name begin (with the count last).
    by: np.ndarray
    begin: np.ndarray
    #: Sorted distinct words, and the index of each item's words in them.
    vocabulary: np.ndarray
    word_ids: np.ndarray


def items_of(table: pa.Table, n: int) -> Items:
    data, offsets = tx.utf8(table["text"])
    words, bounds = word_values(data, offsets)
    ids = table["item_id"].fill_null(-1).to_numpy()
    values, item, place = [], [], []
    for i, (x, y) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if y > x and y - x >= n:
            v = gram_values(words[x:y], n)
            values.append(v)
            item.append(np.full(len(v), i))
            place.append(np.arange(len(v)))
    values = np.concatenate(values) if values else np.zeros(0, np.uint64)
    names, of = np.unique(values, return_inverse=True)
    empty = np.zeros(0, np.int64)
    by = np.argsort(of, kind="stable")
    begin = np.searchsorted(of[by], np.arange(len(names) + 1))
    vocabulary, word_ids = np.unique(words, return_inverse=True)
    return Items(ids, words, bounds, n, names, of, np.concatenate(item) if item else empty,
                 np.concatenate(place) if place else empty, by, begin, vocabulary, word_ids)


def found(names: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted names occur among values: places, and the index of the name."""
    if not len(names):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # most values are no name: their high bits tell
    flags = np.zeros(1 << 16, bool)
    flags[names >> np.uint64(48)] = True
    maybe = np.flatnonzero(flags[values >> np.uint64(48)])
    at = np.minimum(np.searchsorted(names, values[maybe]), len(names) - 1)
    hit = names[at] == values[maybe]
    return maybe[hit], at[hit]


def batches_of(batch: pa.RecordBatch):
    data, offsets = tx.utf8(batch.column("text"))
    for x, y in tx.batches(offsets):
        words, bounds = word_values(data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x])
        yield x, words, bounds


def local_scores(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment score of each row pair of two arrays of words, and where it ends in both."""
    rows, width = b.shape
    above = np.zeros((rows, width + 1), np.int32)
    steps = np.arange(width + 1, dtype=np.int32)
    best, end_a, end_b = np.zeros(rows, np.int32), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i in range(a.shape[1]):
        now = np.zeros_like(above)
        now[:, 1:] = np.maximum(above[:, :-1] + np.where(b == a[:, i:i + 1], 2, -1), above[:, 1:] - 1)
        now = np.maximum(np.maximum.accumulate(now + steps, axis=1) - steps, 0)
        at = now.argmax(1)
        top = now[np.arange(rows), at]
        more = top > best
        best[more], end_a[more], end_b[more] = top[more], i + 1, at[more]
        above = now
    return best, end_a, end_b


def best_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Only the scores: one column of words for each row pair, so that a step is a few operations on rows of cells."""
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    kind = np.int16 if 2 * len(a) + len(b) < 30_000 else np.int32
    width, rows = b.shape
    above, steps, best = np.zeros((width + 1, rows), kind), np.arange(width, dtype=kind)[:, None], np.zeros(rows, kind)
    for word in a:
        now = np.where(b == word, kind(2), kind(-1))
        now += above[:-1]
        above -= 1
        np.maximum(now, above[1:], out=now)
        now += steps
        np.maximum.accumulate(now, axis=0, out=now)
        now -= steps
        np.maximum(now, 0, out=above[1:])
        above[0] = 0
        np.maximum(best, now.max(0), out=best)
    return best


#: Places of seeds in items that are looked at together, and cells of the alignments made together.
_HITS, _CELLS = 1 << 17, 1 << 19


def portions(sizes: np.ndarray, places: np.ndarray, overlap: int) -> Iterator[slice]:
    """Runs of seeds with about _HITS places in items together. Each begins `overlap` words before the end of the last
    one, so that seeds in a row are together in one of them."""
    total, first = np.concatenate([[0], np.cumsum(sizes)]), 0
    while first < len(places):
        last = max(int(np.searchsorted(total, total[first] + _HITS, "right")) - 1, first + 1)
        if last < len(places):  # beyond the overlap, or there is no progress
            last = max(last, int(np.searchsorted(places, places[first] + overlap, "right")))
        yield slice(first, last)
        if last >= len(places):
            return
        first = max(first + 1, int(np.searchsorted(places, places[last - 1] - overlap + 1)))


@dataclass
class Candidates:
    """Parts of texts that may hold an item, and what is known of each."""

    doc: np.ndarray
    item: np.ndarray
    low: np.ndarray
    high: np.ndarray
    copied: np.ndarray  # has enough words in a row
    rarity: np.ndarray  # items that have its rarest seed

    def of(self, some: np.ndarray) -> Candidates:
        return Candidates(*(c[some] for c in (self.doc, self.item, self.low, self.high, self.copied, self.rarity)))


def candidates(items: Items, places: np.ndarray, gram: np.ndarray, bounds: np.ndarray, least: float,
               verbatim: int) -> Candidates:
    """From seeds of texts: chains of seeds on near diagonals, with all words that an alignment through them can have."""
    begin, sizes = items.begin[gram], items.begin[gram + 1] - items.begin[gram]
    hit = items.by[np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
    places, common = np.repeat(places, sizes), np.repeat(sizes, sizes)
    doc = np.searchsorted(bounds, places, "right") - 1
    inside = places + items.n <= bounds[doc + 1]
    doc, item, places, diagonal = doc[inside], items.item[hit][inside], places[inside], (places - items.place[hit])[inside]
    order = np.lexsort((places, diagonal, item, doc))
    doc, item, places, diagonal, common = doc[order], item[order], places[order], diagonal[order], common[inside][order]
    if not len(doc):
        none = np.zeros(0, np.int64)
        return Candidates(none, none, none, none, none.astype(bool), none)
    length = np.diff(items.bounds)
    # seeds in a row on one diagonal are words in a row
    apart = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(diagonal) != 0) | (np.diff(places) != 1)
    first = np.flatnonzero(np.concatenate(([True], apart)))
    row_words = np.diff(np.concatenate((first, [len(doc)]))) + items.n - 1
    copied = np.zeros(len(doc), bool)
    copied[first] = row_words >= verbatim
    # as many further words as an alignment with a score of `least` can have inside
    slack = np.ceil(2 * (1 - least) * length[item]).astype(np.int64)
    new = np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(diagonal) > slack[1:])))
    at = np.flatnonzero(new)
    last = np.concatenate((at[1:], [len(doc)])) - 1
    low = np.maximum(bounds[doc[at]], diagonal[at] - slack[at])
    high = np.minimum(bounds[doc[at] + 1], diagonal[last] + length[item[at]] + slack[at])
    return Candidates(doc[at], item[at], low, high, np.logical_or.reduceat(copied, at), np.minimum.reduceat(common, at))


def enough_words(items: Items, found_: Candidates, ids: np.ndarray, bounds: np.ndarray, least: float) -> Candidates:
    """The candidates that have as many of the item's words as a score of `least` takes: each point of the score is two for
    a word that is equal, less penalties. First whole texts are looked at, then the candidates' own parts."""
    length = np.diff(items.bounds)

    def item_words(c: Candidates) -> tuple[np.ndarray, np.ndarray]:
        sizes = length[c.item]
        begin = np.cumsum(sizes) - sizes
        return items.word_ids[np.repeat(items.bounds[c.item] - begin, sizes) + np.arange(sizes.sum())], begin

    def kept(c: Candidates, has: np.ndarray, begin: np.ndarray) -> Candidates:
        equal = np.add.reduceat(has.astype(np.int64), begin) if len(begin) else begin
        return c.of(np.flatnonzero((equal >= np.ceil(least * length[c.item] - 1e-9)) | c.copied))

    present = np.zeros(len(items.vocabulary) + 1, bool)  # the last is for words that no item has
    parts, edges = [], np.flatnonzero(np.diff(found_.doc, prepend=-1, append=-1))
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own = ids[bounds[found_.doc[i]]:bounds[found_.doc[i] + 1]]
        present[own] = True
        present[-1] = False
        some = found_.of(np.arange(i, j))
        which, begin = item_words(some)
        parts.append(kept(some, present[which], begin))
        present[own] = False
    if not parts:
        return found_
    names = ("doc", "item", "low", "high", "copied", "rarity")
    near = Candidates(*(np.concatenate([getattr(p, c) for p in parts]) for c in names))
    # Where words occur: sorted by word, then place.
    known = np.flatnonzero(ids < len(items.vocabulary))
    where = np.sort(ids[known] * len(ids) + known)
    which, begin = item_words(near)
    sizes = length[near.item]
    after = np.searchsorted(where, which * len(ids) + np.repeat(near.low, sizes))
    has = np.concatenate([where, [np.iinfo(np.int64).max]])[after] < which * len(ids) + np.repeat(near.high, sizes)
    return kept(near, has, begin)


def align(items: Items, words: np.ndarray, bounds: np.ndarray, least: float, verbatim: int, any_: bool = False):
    """(text, item, score, first and last word) of alignments of some texts with the items they share seeds with. With
    `any_`, texts that have an item already are not looked at further."""
    places, gram = found(items.names, gram_values(words, items.n))
    at = np.minimum(np.searchsorted(items.vocabulary, words), len(items.vocabulary) - 1) if len(items.vocabulary) else None
    if at is None or not len(places):
        return []
    ids = np.where(items.vocabulary[at] == words, at, len(items.vocabulary))  # in the vocabulary of all items
    length = np.diff(items.bounds)
    out: dict[tuple[int, int], tuple[float, int, int]] = {}
    done_texts = np.zeros(len(bounds), bool)
    for part in portions(items.begin[gram + 1] - items.begin[gram], places, max(verbatim, items.n)):
        c = candidates(items, places[part], gram[part], bounds, least, verbatim)
        c = enough_words(items, c, ids, bounds, least)
        if any_:
            c = c.of(np.flatnonzero(~done_texts[c.doc]))
        # Rare seeds first, and of equal size what is aligned together.
        rounds = np.split(np.argsort(c.rarity, kind="stable"), [len(c.doc) // 8]) if any_ else [np.arange(len(c.doc))]
        for some in rounds:
            if any_:
                some = some[~done_texts[c.doc[some]]]
            for key, best in _aligned(items, words, ids, bounds, c.of(some), length, least):
                done_texts[key[0]] = True
                if key not in out or best[0] > out[key][0]:
                    out[key] = best
    return [(*k, *v) for k, v in sorted(out.items())]


def _aligned(items: Items, words: np.ndarray, ids: np.ndarray, bounds: np.ndarray, c: Candidates, length: np.ndarray,
             least: float):
    """((text, item), (score, first and last word)) of the candidates that hold their item."""
    order, done = np.argsort(c.high - c.low, kind="stable"), 0
    while done < len(order):
        widest = int((c.high - c.low)[order[min(len(order), done + 256) - 1]])
        some = order[done:done + max(1, _CELLS // widest)][:256]
        done += len(some)
        low, high, item = c.low[some], c.high[some], c.item[some]
        score = best_scores(_padded(items.word_ids, items.bounds[item], length[item], -1),
                            _padded(ids, low, high - low, -2)) / (2.0 * length[item])
        some = some[(score >= least) | c.copied[some]]
        if not len(some):
            continue
        low, high, item = c.low[some], c.high[some], c.item[some]
        best, end_a, end_b = local_scores(_padded(items.words, items.bounds[item], length[item], 0),
                                          _padded(words, low, high - low, 1))
        score = best / (2.0 * length[item])
        # where it starts: the same, backwards from where it ends
        back_a = _padded(items.words[::-1], len(items.words) - items.bounds[item] - end_a, end_a, 0)
        back_b = _padded(words[::-1], len(words) - low - end_b, end_b, 1)
        start_b = end_b - local_scores(back_a, back_b)[2]
        for g, s in enumerate(start_b.tolist()):
            doc = int(c.doc[some[g]])
            base = int(low[g] - bounds[doc])
            yield (doc, int(item[g])), (float(score[g]), base + s, base + int(end_b[g]) - 1)


def _padded(words: np.ndarray, start: np.ndarray, size: np.ndarray, pad: int) -> np.ndarray:
    """Rows of words, filled up with a value that no word of the other side has."""
    steps = np.arange(int(size.max(initial=1)))
    inside = steps < size[:, None]
    out = words[np.where(inside, start[:, None] + steps, 0)]
    out[~inside] = pad
    return out


def blocks(benchmark: DataFrame, block_words: int) -> Iterator[pa.Table]:
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    number = max(1, math.ceil((benchmark.agg(F.sum(words)).first()[0] or 0) / block_words))
    part = F.pmod(F.xxhash64("item_id"), F.lit(number))
    for i in range(number):
        yield benchmark.where(part == i).select("item_id", "text").toArrow().sort_by("item_id")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.4, n: int = 3, verbatim: int = 13,
                 block_words: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word, n_item_words): documents that hold copies of items."""
    out = None
    for table in blocks(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(items_of(table, n))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            length = np.diff(own.bounds)
            for batch in batches:
                ids, rows = batch.column("doc_id").to_pylist(), []
                for x, words, bounds in batches_of(batch):
                    rows += [(ids[x + d], int(own.ids[i]), s, a, b, int(length[i]))
                             for d, i, s, a, b in align(own, words, bounds, least, verbatim)]
                columns = list(zip(*rows, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 [p.split()[0] for p in MATCHES.split(", ")])

        found_ = docs.select("doc_id", "text").mapInArrow(run, MATCHES)
        out = found_ if out is None else out.unionByName(found_)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.4, n: int = 3, verbatim: int = 13,
                   block_words: int = 1_000_000) -> DataFrame:
    """The documents, all columns, that hold no copy of an item."""
    out = docs
    for table in blocks(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(items_of(table, n))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for x, words, bounds in batches_of(batch):
                    clean[[x + m[0] for m in align(shared.value, words, bounds, least, verbatim, any_=True)]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
    return out
