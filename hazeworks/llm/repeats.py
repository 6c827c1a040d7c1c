"""Windows of a fixed length that occur more than once in a corpus, found in blocks that hold all that can match.

A window is `window` consecutive symbols (bytes or words) of one document. Its anchor is the part of `gram` symbols in
it with the smallest hash (the leftmost, if several have it). Equal windows have equal anchors at equal offsets, so
windows need comparing only under the same anchor. The run of windows with one anchor, and the text they span, is the
anchor's context; every window belongs to exactly one context.

1. Homes send (anchor, context hash, smallest document, number) to the anchors' buckets. Buckets answer: an anchor seen
   once is done, equal contexts alone under an anchor repeat as a whole, and all other contexts have to be compared.
2. Homes send one copy of each such context, as text. Buckets index these and answer for each window of each context.
3. Homes look their windows up and remove what is covered.

An anchor with more than `most` different contexts (a line in very many documents) would make one large block. Its
homes send the hashes of its windows in step 2 instead, which spread over all buckets, and equal ones combine. No
window is left out either way. A home that has more than `most_in_home` contexts of an anchor does not list them in step 1:
it says so in one entry, and the anchor is dealt with in this way everywhere. An anchor thus has a bounded number of
entries a home, however many documents hold it.

Contexts are taken as equal if anchor and context hash are, windows sent as hashes if two hashes are: 128 bits each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hazeworks.llm import exchange as ex
from hazeworks.llm import text as tx

_CHUNK = (1 << 20) - 4096  # places whose position fits into the low 20 bits of a sort key
_NEVER = np.iinfo(np.int64).max
WHOLE, COPY, LISTED, SPLIT = 1, 2, 4, 8
#: In place of the number of a context: the anchor has more contexts in this home than are listed.
UNLISTED = 3


@dataclass(frozen=True)
class Scheme:
    """What a window is, and when it counts as repeated.

    by_smaller: only if it also starts in a document with a smaller id; else if it starts anywhere else.
    compare(sequences of a block, their smallest documents, window, their anchors, the anchors' places): for each
    sequence and window of it, the smallest document that has the window, or _NEVER if it occurs once.
    """

    window: int
    gram: int
    by_words: bool
    by_smaller: bool
    compare: Callable[[list[np.ndarray], np.ndarray, int, np.ndarray, np.ndarray], list[np.ndarray]]
    most: int = 2000
    most_in_home: int = 64
    block: int = 1 << 21


@dataclass
class Part:
    """Some documents of a home, with the runs of windows of each anchor."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray  # bytes of symbols
    ends: np.ndarray
    bounds: np.ndarray  # symbols of documents
    hashed: tx.Hashed
    symbols: np.ndarray
    anchor: np.ndarray
    context: np.ndarray
    low: np.ndarray
    high: np.ndarray  # last window, included
    place: np.ndarray  # of the anchor, from the first window
    doc: np.ndarray  # of each run, counted in the home

    def text(self, run: int, window: int) -> np.ndarray:
        last = self.high[run] + window - 1
        return self.data[self.starts[self.low[run]]:self.ends[last]]


def anchor_runs(hashed: tx.Hashed, bounds: np.ndarray, window: int, gram: int):
    """For each run of windows with one anchor: the anchor's place, the first and the last window."""
    count = int(bounds[-1]) - window + 1
    if count <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    grams, width, places = hashed.grams(gram), window - gram + 1, []
    bits = np.uint64(20)
    for a in range(0, count, _CHUNK):
        part = grams[a:min(count, a + _CHUNK) + width - 1]
        key = ((part >> bits) << bits) | np.arange(len(part), dtype=np.uint64)
        wide = 1
        while wide * 2 <= width:
            key = np.minimum(key[:-wide], key[wide:])
            wide *= 2
        if width > wide:
            key = np.minimum(key[:wide - width], key[width - wide:])
        places.append((key & np.uint64((1 << 20) - 1)).astype(np.int64) + a)
    place = np.concatenate(places)
    inside = np.ones(count, bool)  # not the windows that would reach into the next document
    for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        inside[max(x, y - window + 1):y] = False
    same = np.zeros(count, bool)
    same[1:] = inside[1:] & inside[:-1] & (place[1:] == place[:-1])
    first = np.flatnonzero(inside & ~same)
    last = np.flatnonzero(inside & ~np.concatenate((same[1:], [False])))
    # smallest hashes are small: spread them again
    return place[first], first, last, tx.mix(grams[place[first]])


def parts(table: pa.Table, scheme: Scheme) -> Iterator[Part]:
    data, offsets = tx.utf8(table["text"])
    for x, y in tx.batches(offsets):
        some, where = data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x]
        if scheme.by_words:
            starts, ends, bounds = tx.words(some, where)
            symbols = tx.word_hashes(some, starts, ends)
        else:
            starts, bounds, symbols = np.arange(len(some), dtype=np.int32), where, some
            ends = starts + 1
        hashed = tx.Hashed(symbols)
        place, low, high, anchor = anchor_runs(hashed, bounds, scheme.window, scheme.gram)
        context = hashed.of(low, high + scheme.window) ^ tx.mix((place - low).astype(np.uint64))
        doc = np.searchsorted(bounds, low, "right") - 1
        yield Part(x, some, where, starts, ends, bounds, hashed, symbols, anchor, context, low, high, place - low,
                   doc + x)


def combined(keys: list[np.ndarray], least: np.ndarray, many: np.ndarray):
    """Sorted distinct keys, the smallest document and the number (2 stands for more) of each; and an example."""
    by = np.lexsort(keys[::-1])
    if not len(by):
        return [k[by] for k in keys], least[by], many[by], by
    new = np.zeros(len(by), bool)
    new[0] = True
    for k in keys:
        new[1:] |= np.diff(k[by]) != 0
    at = np.flatnonzero(new)
    number = np.minimum(2, np.add.reduceat(many[by].astype(np.int64), at)).astype(np.uint8)
    return [k[by][at] for k in keys], np.minimum.reduceat(least[by], at), number, by[at]


def doc_ids(table: pa.Table, scheme: Scheme) -> np.ndarray:
    """Ids that decide; without such a rule every window that repeats at all is below every document."""
    if scheme.by_smaller:
        return table["doc_id"].fill_null(_NEVER).to_numpy()
    return np.full(table.num_rows, np.iinfo(np.int64).min)


def send_anchors(table: pa.Table, scheme: Scheme, buckets: int) -> pa.Table:
    none = np.zeros(0, np.uint64)
    found = [(none, none, np.zeros(0, np.int64)), *((p.anchor, p.context, p.doc) for p in parts(table, scheme))]
    *keys, doc = (np.concatenate(c) for c in zip(*found, strict=True))
    least = doc_ids(table, scheme)[doc]
    (anchor, context), least, many, _ = combined(keys, least, np.ones(len(least), np.uint8))
    if len(anchor):
        at = np.flatnonzero(np.concatenate(([True], np.diff(anchor) != 0)))
        sizes = np.diff(np.concatenate((at, [len(anchor)])))
        over = at[sizes > scheme.most_in_home]
        least[over] = np.minimum.reduceat(least, at)[sizes > scheme.most_in_home]
        many[over], context[over] = UNLISTED, 0
        listed = np.repeat(sizes <= scheme.most_in_home, sizes)
        listed[over] = True
        anchor, context, least, many = anchor[listed], context[listed], least[listed], many[listed]
    home = int(table[ex.HOME][0].as_py())
    return ex.blocks_table(ex.to_buckets(home, anchor, [context, least, many], buckets))


def answers(bucket: int, homes: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    if not len(homes):
        return ex.blocks_table([])
    by = np.argsort(homes, kind="stable")
    names, at = np.unique(homes[by], return_index=True)
    rows = [(bucket, int(h), ex.pack(*(c[by[x:y]] for c in columns)))
            for h, x, y in zip(names, at, [*at[1:], len(by)], strict=True)]
    return ex.blocks_table(rows)


def meet_anchors(table: pa.Table, scheme: Scheme) -> pa.Table:
    homes, blocks = ex.gather(table)
    who = np.repeat(homes, [len(b[0]) for b in blocks])
    anchor, context, least, many = (np.concatenate(c) for c in zip(*blocks, strict=True))
    by = np.lexsort((who, context, anchor))
    who, anchor, context, least, many = who[by], anchor[by], context[by], least[by], many[by].astype(np.int64)
    new_anchor = np.concatenate(([True], np.diff(anchor) != 0))
    new_pair = new_anchor | np.concatenate(([True], np.diff(context) != 0))
    group, pair = np.cumsum(new_anchor) - 1, np.cumsum(new_pair) - 1
    at, at_pair = np.flatnonzero(new_anchor), np.flatnonzero(new_pair)
    repeats = np.add.reduceat(many, at)[group] > 1
    contexts = np.add.reduceat(new_pair.astype(np.int64), at)[group]
    smallest = np.minimum.reduceat(least, at)[group]
    copied = np.add.reduceat(many, at_pair)[pair] > 1
    unlisted = np.maximum.reduceat(many == UNLISTED, at)[group]
    alone, split = (contexts == 1) & ~unlisted, (contexts > scheme.most) | unlisted
    kind = np.where(alone, WHOLE, np.where(split, SPLIT, np.where(new_pair, COPY, LISTED)))
    if not scheme.by_smaller:  # a context with a copy is decided; one copy still goes to the block, for the others
        kind = np.where(copied & ~alone & ~split, np.where(new_pair, WHOLE | COPY, WHOLE), kind)
    keep = repeats
    return answers(int(table[ex.BUCKET][0].as_py()), who[keep],
                   [anchor[keep], context[keep], kind[keep].astype(np.uint8), smallest[keep]])


def told_to(table: pa.Table, wide: int, kinds: bool = True) -> list[np.ndarray]:
    """The columns of all answers to a home that have so many. Two sorts have four: with kinds of contexts (small
    numbers), and with values of windows."""
    blocks = [b for b in ex.gather(table)[1] if len(b) == wide and (wide != 4 or (b[2].dtype == np.uint8) == kinds)]
    return [np.concatenate(c) for c in zip(*blocks, strict=True)] if blocks else []


def find(names: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The row of each key among names, -1 if there is none."""
    if not len(names):
        return np.full(len(key), -1)
    by = np.argsort(names, kind="stable")
    at = by[np.minimum(np.searchsorted(names[by], key), len(names) - 1)]
    return np.where(names[at] == key, at, -1)


def split_windows(part: Part, run: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some runs: their starts, two hashes of each, and their runs."""
    if not len(run):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), run
    sizes = part.high[run] - part.low[run] + 1
    start = np.repeat(part.low[run] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    other = tx.Hashed(tx.mix(part.symbols.astype(np.uint64) + np.uint64(7)))
    return start, part.hashed.of(start, start + window), other.of(start, start + window), np.repeat(run, sizes)


def send_contexts(docs: pa.Table, told: pa.Table, scheme: Scheme, buckets: int) -> pa.Table:
    """Texts and lists of contexts to compare, and hashes of windows to count."""
    answer = told_to(told, 4)
    if not answer or not docs.num_rows:
        return ex.blocks_table([])
    anchor, context, kind, _ = answer
    asked = (kind & (COPY | LISTED)) > 0
    anchor, context, kind, split = anchor[asked], context[asked], kind[asked], np.unique(anchor[kind == SPLIT])
    ids = doc_ids(docs, scheme)
    keys, texts, windows = [], [], []
    for p in parts(docs, scheme):
        at = find(context, p.context)
        run = np.flatnonzero(at >= 0)
        run = run[anchor[at[run]] == p.anchor[run]]
        keys.append((p.anchor[run], p.context[run], ids[p.doc[run]], p.place[run].astype(np.uint32)))
        for r, row in zip(run, at[run], strict=True):
            texts.append(p.text(r, scheme.window) if kind[row] & COPY else None)
        _, *names, owner = split_windows(p, np.flatnonzero(np.isin(p.anchor, split)), scheme.window)
        windows.append((*names, ids[p.doc[owner]]))
    home = int(docs[ex.HOME][0].as_py())
    columns = [np.concatenate(c) for c in zip(*keys, strict=True)]
    (anchor, context), least, _, example = combined(columns[:2], columns[2], np.ones(len(columns[0]), np.uint8))
    place = columns[3][example]
    chosen = [texts[i] if texts[i] is not None else np.zeros(0, np.uint8) for i in example]
    shift, rows = np.uint64(64 - (buckets.bit_length() - 1)), []
    bucket = (anchor >> shift).astype(np.int64) if len(anchor) else np.zeros(0, np.int64)
    for b in np.unique(bucket):
        x, y = np.searchsorted(bucket, [b, b + 1])
        sizes = np.array([len(t) for t in chosen[x:y]], np.int32)
        rows.append((int(b), home, ex.pack(
            anchor[x:y], context[x:y], least[x:y], sizes, place[x:y], np.concatenate(chosen[x:y]))))
    *names, smallest = (np.concatenate(c) for c in zip(*windows, strict=True))
    (name, other), smallest, many, _ = combined(names, smallest, np.ones(len(smallest), np.uint8))
    return ex.blocks_table(rows + ex.to_buckets(home, name, [other, smallest, many], buckets))


def compare_contexts(table: pa.Table, scheme: Scheme) -> pa.Table:
    """For each listed context, the smallest document of each of its windows; the same for windows sent as hashes."""
    homes, blocks = ex.gather(table)
    bucket, out = int(table[ex.BUCKET][0].as_py()), []
    sent = [(h, b) for h, b in zip(homes, blocks, strict=True) if len(b) == 4]
    if sent:
        who = np.repeat([h for h, _ in sent], [len(b[0]) for _, b in sent])
        name, other, least, many = (np.concatenate(c) for c in zip(*(b for _, b in sent), strict=True))
        by = np.lexsort((other, name))
        who, name, other, least, many = who[by], name[by], other[by], least[by], many[by]
        new = np.concatenate(([True], (np.diff(name) != 0) | (np.diff(other) != 0)))
        group, at = np.cumsum(new) - 1, np.flatnonzero(new)
        keep = np.add.reduceat(many.astype(np.int64), at)[group] > 1
        smallest = np.minimum.reduceat(least, at)[group]
        out.append(answers(bucket, who[keep], [name[keep], other[keep], smallest[keep]]))
    sent = [(h, b) for h, b in zip(homes, blocks, strict=True) if len(b) == 6]
    if sent:
        who = np.repeat([h for h, _ in sent], [len(b[0]) for _, b in sent])
        anchor, context, least, sizes, place, data = (np.concatenate(c) for c in zip(*(b for _, b in sent), strict=True))
        ends = np.cumsum(sizes, dtype=np.int64)
        by = np.lexsort((-sizes, context, anchor))  # of equal contexts the one with text comes first
        new = np.concatenate(([True], (np.diff(anchor[by]) != 0) | (np.diff(context[by]) != 0)))
        pair = np.cumsum(new) - 1
        first = by[new]
        smallest = np.minimum.reduceat(least[by], np.flatnonzero(new))
        texts = [data[ends[i] - sizes[i]:ends[i]] for i in first]
        values, done = [], 0
        names = anchor[first]
        size = np.cumsum([len(t) for t in texts])
        while done < len(texts):  # blocks of whole anchors
            stop = max(done + 1, int(np.searchsorted(size, (size[done - 1] if done else 0) + scheme.block)))
            stop = int(np.searchsorted(names, names[stop - 1], "right"))
            values += scheme.compare(texts[done:stop], smallest[done:stop], scheme.window, names[done:stop],
                                     place[first[done:stop]].astype(np.int64))
            done = stop
        counts = np.array([len(v) for v in values], np.int32)
        begins, flat = np.concatenate(([0], np.cumsum(counts))), np.concatenate(values)
        some = np.array([bool((v != _NEVER).any()) for v in values])
        index = np.empty(len(by), np.int64)
        index[by] = pair
        for h in np.unique(who):
            mine = np.flatnonzero((who == h) & some[index])
            if len(mine):
                i = index[mine]
                out.append(ex.blocks_table([(bucket, int(h), ex.pack(
                    anchor[mine], context[mine], counts[i],
                    np.concatenate([flat[begins[j]:begins[j + 1]] for j in i])))]))
    return pa.concat_tables(out) if out else ex.blocks_table([])


def removed_windows(docs: pa.Table, told: pa.Table, scheme: Scheme) -> Iterator[tuple[Part, np.ndarray]]:
    """For each part of a home, the starts of the windows to remove."""
    ids = doc_ids(docs, scheme)
    kinds, values, hashes = told_to(told, 4), told_to(told, 4, kinds=False), told_to(told, 3)
    split = np.unique(kinds[0][kinds[2] == SPLIT]) if kinds else np.zeros(0, np.uint64)
    begins = np.concatenate(([0], np.cumsum(values[2], dtype=np.int64))) if values else None
    for p in parts(docs, scheme):
        gone = [np.zeros(0, np.int64)]
        if kinds:
            whole = (kinds[2] & WHOLE) > 0
            anchor, context, _, smallest = (c[whole] for c in kinds)
            at = find(context, p.context)
            run = np.flatnonzero(at >= 0)
            run = run[(anchor[at[run]] == p.anchor[run]) & (smallest[at[run]] < _below(ids[p.doc[run]], scheme))]
            sizes = p.high[run] - p.low[run] + 1
            gone.append(np.repeat(p.low[run] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum()))
        if values:
            at = find(values[1], p.context)
            run = np.flatnonzero(at >= 0)
            run = run[values[0][at[run]] == p.anchor[run]]
            sizes = p.high[run] - p.low[run] + 1
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            value = values[3][np.repeat(begins[at[run]], sizes) + inside]
            hit = value < np.repeat(_below(ids[p.doc[run]], scheme), sizes)
            gone.append((np.repeat(p.low[run], sizes) + inside)[hit])
        if hashes and len(split):
            start, name, other, owner = split_windows(p, np.flatnonzero(np.isin(p.anchor, split)), scheme.window)
            at = find(hashes[0], name)
            row = np.maximum(at, 0)
            hit = (at >= 0) & (hashes[1][row] == other) & (hashes[2][row] < _below(ids[p.doc[owner]], scheme))
            gone.append(start[hit])
        yield p, np.concatenate(gone)


def _below(ids: np.ndarray, scheme: Scheme) -> np.ndarray:
    return ids if scheme.by_smaller else np.full(len(ids), _NEVER)


def without_repeats(docs: DataFrame, scheme: Scheme, describe: Callable[[pa.Table, Iterator], pa.Table],
                    schema: T.StructType, home_bytes: int = 8 << 20) -> DataFrame:
    """describe(documents of a home, (part, removed windows) pairs) as rows of the schema, over all documents.

    docs has doc_id, text and any other columns; describe gets them all.
    """
    buckets = ex.bucket_count(docs)
    homes = ex.with_homes(docs, home_bytes, by=("doc_id", "text"))

    def tell(key, table):
        return send_anchors(table, scheme, buckets)

    def meet(key, table):
        return meet_anchors(table, scheme)

    def send(key, left, right):
        return send_contexts(left, right, scheme, buckets)

    def compare(key, table):
        return compare_contexts(table, scheme)

    def apply(key, left, right):
        if not left.num_rows:
            return pa.table({f.name: [] for f in arrow}, schema=arrow)
        return describe(left, removed_windows(left, right, scheme))

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    sent = homes.groupBy(ex.HOME).applyInArrow(tell, ex.BLOCKS)
    met = ex.spread(sent).groupBy(ex.BUCKET).applyInArrow(meet, ex.BLOCKS)
    texts = homes.groupBy(ex.HOME).cogroup(met.groupBy(ex.HOME)).applyInArrow(send, ex.BLOCKS)
    compared = ex.spread(texts).groupBy(ex.BUCKET).applyInArrow(compare, ex.BLOCKS)
    told = met.unionByName(compared)
    return homes.groupBy(ex.HOME).cogroup(told.groupBy(ex.HOME)).applyInArrow(apply, schema)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
