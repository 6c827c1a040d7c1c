"""Quality classifier by importance resampling.

Generative models of hashed n-grams (words and runs of punctuation, lower-cased; one and two in a row) are fitted for
target text (labelled good and not toxic) and for rejects. The target model is smoothed towards the counts of the
whole corpus. In place of a model of all raw text (the README has the reason and the price), the denominator is a mixture
of the kinds of labelled rejects, each with its share among the labelled documents, so that a rare kind of bad text
weighs in. A reject model has its own probability for the cells whose counts differ from
the target's beyond doubt (`least` n-grams, `factor` times, six deviations), within exp(`clip`) of the target's, and the
target's, scaled to what is left, for all others; otherwise chance would drown the few words that tell.

A document's log weight is log p(target) - log p(raw), shares included. Keys are log weight plus Gumbel noise; the k
largest keys are a sample without replacement in proportion to the weights. k is the number of documents, of all, that
are more likely target than raw text.

`temperature` scales the noise: 1 samples in proportion to the weights; the default 0.1, to their tenth power, so that
short clean texts, whose weights are near 1, are not left to chance.

Two equal words in a row are one n-gram of their own whatever the word, so that endless repetition of unseen words shows.

Bounds: the models have `buckets` cells each (2**17: 0.5 MB a kind) and are sent to all tasks, as are ids and classes
of `most_labels` labelled documents (200,000: 2.4 MB), chosen by a hash of the id if there are more. Corpus counts are
over all documents. Cases: null and empty texts have no n-gram, so their weight is the target's share among
labels; documents labelled twice count for each label; without target or reject labels, weights are 0 and all are kept;
repeated rows share one key; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeworks.llm import text as tx
from hazeworks.llm.exchange import pack, unpack
from hazeworks.llm.saving import prefix_cut, saved, up_to

#: Classes: 0 any document, 1 target, 2 low quality, 3 toxic, 4 both.
CLASSES = 5
_KIND = np.full(256, 2, np.uint8)  # 0 parts tokens, 1 punctuation, 2 letters, digits and all beyond ASCII
_KIND[list(range(0x21))] = 0
_KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 1


def ngrams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all n-grams of some texts, and the text of each."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    edge = np.flatnonzero(edge)
    token = kind[edge[:-1]] > 0
    starts, ends = edge[:-1][token], edge[1:][token]
    doc = np.searchsorted(offsets, starts, "right") - 1
    one = tx.word_hashes(tx.LOWER[data], starts, ends)
    two = np.where(one[1:] == one[:-1], np.uint64(1), tx.mix(one[:-1] * np.uint64(3) + one[1:]))
    together = doc[1:] == doc[:-1]
    cells = np.concatenate((one, two[together])) >> np.uint64(64 - (buckets.bit_length() - 1))
    return cells.astype(np.int64), np.concatenate((doc, doc[1:][together]))


def _parts(table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = tx.utf8(table.column("text"))
    for x, y in tx.batches(offsets):
        yield x, y, data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x]


def labelled(labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, sorted, and classes (as bits) of about `most` labelled documents at most, chosen by a hash of the id."""
    reject = F.when(F.col("quality") == 1, F.when(F.col("toxic") == 0, 1).otherwise(3)).otherwise(
        F.when(F.col("toxic") == 1, 4).otherwise(2))
    kinds = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select(
        "doc_id", reject.alias("class"))
    kinds = kinds.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1, class)")).alias("classes"))
    share = most / max(1, kinds.count())
    if share < 1:
        kinds = kinds.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    table = kinds.toArrow().sort_by("doc_id")
    return table["doc_id"].to_numpy(), table["classes"].to_numpy()


def counted(docs: DataFrame, labels: DataFrame, buckets: int, most_labels: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all cells, and numbers of documents, by class. Tasks send their counts in sections, summed apart."""
    known = docs.sparkSession.sparkContext.broadcast(labelled(labels, most_labels))
    sections = 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES, buckets), np.int64)
        texts = np.zeros(CLASSES, np.int64)
        names, bits = known.value
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            of = np.zeros((len(ids), CLASSES), bool)
            of[:, 0] = True
            if len(names):
                at = np.minimum(np.searchsorted(names, ids), len(names) - 1)
                own = np.where(names[at] == ids, bits[at], 0)
                of[:, 1:] = (own[:, None] >> np.arange(1, CLASSES)) & 1
            texts += of.sum(0)
            for x, _, data, offsets in _parts(batch):
                cell, doc = ngrams(data, offsets, buckets)
                for c in range(CLASSES):
                    total[c] += np.bincount(cell[of[x + doc, c]], minlength=buckets)
        parts = np.split(total.reshape(-1), sections)
        yield pa.RecordBatch.from_arrays([pa.array(range(sections), pa.int32()), pa.array([
            pack(p, texts if i == 0 else texts[:0]) for i, p in enumerate(parts)], pa.binary())], ["section", "block"])

    def add(key, table):
        parts, texts = zip(*(unpack(b.as_py()) for b in table["block"]), strict=True)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([pack(sum(parts), sum(texts))], pa.binary())],
                        names=["section", "block"])

    form = "section int, block binary"
    rows = docs.select("doc_id", "text").mapInArrow(run, form).groupBy("section").applyInArrow(add, form).collect()
    blocks = {r["section"]: unpack(r["block"]) for r in rows}
    if not blocks:
        return np.zeros((CLASSES, buckets), np.int64), np.zeros(CLASSES, np.int64)
    return np.concatenate([blocks[i][0] for i in range(sections)]).reshape(CLASSES, buckets), blocks[0][1]


class Models:
    """Log ratios of cells, raw to target, for each kind of reject, and the kinds' log shares to the target's."""

    def __init__(self, counts: np.ndarray, texts: np.ndarray, least: int, factor: float, clip: float):
        counts = counts.astype(float)
        buckets = counts.shape[1]
        corpus = (counts[0] + 0.5) / (counts[0].sum() + 0.5 * buckets)
        target = (counts[1] + buckets * corpus) / (counts[1].sum() + buckets)
        ratios, shares = [], []
        for own, number in zip(counts[2:], texts[2:], strict=True):
            if texts[1] == 0 or number == 0 or own.sum() == 0:
                continue
            expected = own.sum() * target
            more = (own >= least) & (own >= factor * expected) & (own - expected >= 6 * np.sqrt(expected + 1))
            less = (expected >= 4 * least) & (factor * own <= expected)
            told = more | less
            ratio = np.clip(np.log((own + 0.5) / (expected + 0.5)), -clip, clip)
            rest = [np.log(max(1e-3, 1 - share)) for share in (own[told].sum() / own.sum(), target[told].sum())]
            ratios.append(np.where(told, ratio, rest[0] - rest[1]))
            shares.append(np.log(number / texts[1]))
        self.fitted = bool(ratios)
        self.log, self.shares = np.array(ratios, np.float32), np.array(shares)

    def weights(self, cell: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
        """log p(target) - log p(raw), each with its share."""
        if not self.fitted:
            return np.zeros(texts)
        raw = np.stack([np.bincount(doc, row[cell], texts) for row in self.log]) + self.shares[:, None]
        top = raw.max(0)
        return -(top + np.log(np.exp(raw - top).sum(0)))


def weighed(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 17, least: int = 20, factor: float = 4.0,
            clip: float = 3.0, temperature: float = 0.1, seed: int = 7, most_labels: int = 200_000) -> DataFrame:
    """All columns of docs and __ngrams, __log_weight, __key."""
    counts, texts = counted(docs, labels, buckets, most_labels)
    model = docs.sparkSession.sparkContext.broadcast(Models(counts, texts, least, factor, clip))
    extra = [("__ngrams", pa.int64()), ("__log_weight", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for x, y, data, offsets in _parts(batch):
                cell, doc = ngrams(data, offsets, buckets)
                number[x:y] = np.bincount(doc, minlength=y - x)
                weight[x:y] = model.value.weights(cell, doc, y - x)
            for (name, kind), values in zip(extra, (number, weight), strict=True):
                batch = batch.append_column(name, pa.array(values, kind))
            yield batch

    schema = T.StructType([*docs.schema.fields, T.StructField("__ngrams", T.LongType()),
                           T.StructField("__log_weight", T.DoubleType())])
    # A number in (0, 1) that depends on the document's id and text, not on its place
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11).cast("double") + 0.5) / float(1 << 53)
    gumbel = -F.log(-F.log(unit))
    return docs.mapInArrow(run, schema).withColumn("__key", F.col("__log_weight") + F.lit(temperature) * gumbel)


def resampled(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The sampled rows of docs with __ngrams, __log_weight, __key."""
    scored = weighed(docs, labels, **options)
    skinny = saved(scored.select("doc_id", "__log_weight", "__key", F.xxhash64("doc_id", "text").alias("__tie")))
    number = skinny.agg(F.count(F.when(F.col("__log_weight") > 0, 1)), F.count(F.when(F.col("__log_weight") != 0, 1))).first()
    if not number[1]:
        return scored
    order = ["__down", "__tie"]
    down = (-F.col("__key")).alias("__down")
    cut = prefix_cut(skinny.select(down, "__tie", F.lit(1).alias("__one")), order, "__one", number[0])
    return scored.where(up_to(order, cut, {"__down": -F.col("__key"), "__tie": F.xxhash64("doc_id", "text")}))
