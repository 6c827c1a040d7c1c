"""Cross-entropy difference scores: how much closer a document is to target text than to the corpus.

Two matched bigram models share one vocabulary, all words of the corpus: the background model is counted over all
documents, the target model over those labelled good and not toxic. Both are smoothed the same way: a word's share
(one more count for every word of the vocabulary), and a bigram's towards it with the strength of `mu` words. A
document's score is the mean, over its words, of the target loss less the background loss, in nats; lower is closer.

Counts meet as in exchange: homes combine their n-grams, buckets add them up and answer each home in the order it asked
in, with the sums of the whole bucket, from which homes know the vocabulary and the sizes of both corpora.

Cases: words are parted by [\x20\x09-\x0D] and lower-cased (A-Z); null and empty texts have no words and null losses; a
document labelled more than once is target text if one of its labels says so; without any target document the target
model knows only the vocabulary; repeated rows count each; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hazeworks.llm import exchange as ex
from hazeworks.llm import text as tx

SCORES = "doc_id bigint, n_tokens bigint, target_nats double, background_nats double, score double"


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its hash, that of the bigram it ends (0: the first of its text), and its text."""
    starts, ends, bounds = tx.words(data, offsets)
    word = tx.word_hashes(tx.LOWER[data], starts, ends)
    pair = np.zeros(len(word), np.uint64)
    pair[1:] = tx.mix(word[:-1] * np.uint64(5) + word[1:])
    pair[bounds[:-1][bounds[:-1] < len(word)]] = 0
    return word, pair, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def all_tokens(table: pa.Table):
    data, offsets = tx.utf8(table["text"])
    parts = [tokens(data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x]) + (x,) for x, y in tx.batches(offsets)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
            np.concatenate([p[2] + p[3] for p in parts]))


def keys(word: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-grams, and where each word and each bigram is among them."""
    names, at = np.unique(np.concatenate((word, pair[pair > 0])), return_inverse=True)
    bigram = np.full(len(word), -1)
    bigram[pair > 0] = at[len(word):]
    return names, at[:len(word)], bigram


def tell(docs: pa.Table, labels: pa.Table, buckets: int) -> pa.Table:
    if not docs.num_rows:
        return ex.blocks_table([])
    word, pair, doc = all_tokens(docs)
    names, at, bigram = keys(word, pair)
    good = np.isin(docs["doc_id"].fill_null(-1).to_numpy(), labels["doc_id"].to_numpy())[doc]
    counts = [np.bincount(at[w], minlength=len(names)) + np.bincount(bigram[w & (bigram >= 0)], minlength=len(names))
              for w in (np.ones(len(word), bool), good)]
    single = np.zeros(len(names), np.uint8)
    single[at] = 1
    columns = [counts[0].astype(np.uint32), counts[1].astype(np.uint32), single]
    return ex.blocks_table(ex.to_buckets(int(docs[ex.HOME][0].as_py()), names, columns, buckets, all_buckets=True))


def add(table: pa.Table) -> pa.Table:
    homes, blocks = ex.gather(table)
    sizes = [len(b[0]) for b in blocks]
    name, every, target, single = (np.concatenate(c) for c in zip(*blocks, strict=True))
    names, first, at = np.unique(name, return_index=True, return_inverse=True)
    every, target = np.bincount(at, every, len(names)), np.bincount(at, target, len(names))
    words = single[first] > 0
    whole = np.array([words.sum(), every[words].sum(), target[words].sum()], np.float64)
    every, target = (np.split(c.astype(np.uint64)[at], np.cumsum(sizes)[:-1]) for c in (every, target))
    bucket = int(table[ex.BUCKET][0].as_py())
    return ex.blocks_table([(bucket, int(h), ex.pack(e, t, whole)) for h, e, t in zip(homes, every, target, strict=True)])


def losses(word: np.ndarray, before: np.ndarray, pair: np.ndarray, size: float, vocabulary: float,
           mu: float) -> np.ndarray:
    """-log P of each word, from the counts of the word, the word before it and both together (-1: first word)."""
    share = (word + 1) / (size + vocabulary)
    return -np.log(np.where(pair < 0, share, (np.maximum(pair, 0) + mu * share) / (before + mu)))


def score(docs: pa.Table, answers: pa.Table, mu: float) -> pa.Table:
    n = docs.num_rows
    word, pair, doc = all_tokens(docs)
    names, at, bigram = keys(word, pair)
    number, sums = np.bincount(doc, minlength=n), []
    if len(word):
        blocks = [ex.unpack(b.as_py()) for b in answers.sort_by(ex.BUCKET)[ex.BLOCK]]
        every, target, whole = (np.concatenate(c) for c in zip(*blocks, strict=True))
        if len(every) != len(names):
            raise ValueError("an answer is missing")
        vocabulary, size, target_size = whole.reshape(-1, 3).sum(0)
        before = np.concatenate((at[:1], at[:-1]))
        for counts, total in ((target, target_size), (every, size)):
            counts = counts.astype(np.float64)
            loss = losses(counts[at], counts[before], np.where(bigram < 0, -1, counts[bigram]), total, vocabulary, mu)
            sums.append(np.bincount(doc, loss, n) / np.maximum(1, number))
    else:
        sums = [np.zeros(n), np.zeros(n)]
    none = number == 0
    columns = [docs["doc_id"].combine_chunks().cast(pa.int64()), pa.array(number)] + [
        pa.array(c, mask=none) for c in (*sums, sums[0] - sums[1])]
    return pa.table(columns, names=["doc_id", "n_tokens", "target_nats", "background_nats", "score"])


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, mu: float = 20.0,
                             home_bytes: int = 8 << 20) -> DataFrame:
    """Per document: doc_id, n_tokens, both mean losses and their difference."""
    buckets = ex.bucket_count(docs)
    homes = ex.with_homes(docs.select("doc_id", "text"), home_bytes)
    good = labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    good = ex.with_homes(good, home_bytes, like=docs)
    sent = homes.groupBy(ex.HOME).cogroup(good.groupBy(ex.HOME)).applyInArrow(
        lambda left, right: tell(left, right, buckets), ex.BLOCKS)
    added = ex.spread(sent).groupBy(ex.BUCKET).applyInArrow(lambda table: add(table), ex.BLOCKS)
    empty = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_nats", pa.float64()),
                       ("background_nats", pa.float64()), ("score", pa.float64())])
    return homes.groupBy(ex.HOME).cogroup(added.groupBy(ex.HOME)).applyInArrow(
        lambda left, right: score(left, right, mu) if left.num_rows else empty.empty_table(), SCORES)
