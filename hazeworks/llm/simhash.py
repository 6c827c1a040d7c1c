"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit place gets a nonzero vector of radius + 1 bits; for each nonzero vector v, the mask of v has the places
whose vector has an odd product with v. Places in which two fingerprints differ, `radius` at most, span at most
`radius` dimensions, so some v is orthogonal to all of them: under its mask the two are equal. One table for each v
therefore brings together every pair within the radius, with certainty.

Equal fingerprints are one row before any table. A table's bucket that is larger than `most` is dealt again, by the
masks of another set of vectors under its own key: the guarantee holds in it as well, and three rounds leave at most a
few hundred fingerprints that can share all keys. Buckets report a forest of their links, not all pairs; links between
different fingerprints are compared exactly, and none is lost.

Cases: null or empty text has the fingerprint zero and is linked like any other; a text with fewer words than a
shingle is one shingle; repeated rows are copies; a null id is never a component's id unless all its ids are null; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeworks.llm.components import components
from hazeworks.llm.saving import saved
from hazeworks.llm.text import utf8

_LEVELS = 3


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Bit b is set if it is set in over half of the XXH64 values of all shingles of lower-cased (A-Z) words."""
    words = text.lower().split()  # for bytes: A-Z only, and parted by [\x20\x09-\x0D]
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    hash_ = xxhash.xxh64_intdigest
    return majority(np.array([hash_(line[x:y], seed) for x, y in zip(starts, ends, strict=True)], np.uint64))


def majority(values: np.ndarray) -> int:
    """The bits that are set in over half of some 64-bit values."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(values), 1 << 14):
        bits = np.unpackbits(values[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(values), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, *carry: str) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a signed number; and further columns of numbers, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            data = data.tobytes()
            values = [fingerprint(data[x:y], shingle, seed)
                      for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), fps, *map(batch.column, carry)],
                                             ["doc_id", "fp", *carry])

    schema = "".join(f", {c} bigint" for c in carry)
    return docs.select("doc_id", "text", *carry).mapInArrow(run, f"doc_id bigint, fp bigint{schema}")


def masks(radius: int, level: int = 0) -> list[int]:
    """The masks of all nonzero vectors, as signed 64-bit numbers.

    Any choice of the places' vectors has the guarantee; of some random ones, that whose smallest mask is largest keeps
    all tables selective.
    """
    size = 1 << (radius + 1)
    best = 0
    for seed in range(200):
        vectors = np.resize(np.random.default_rng((level, seed)).permutation(np.arange(1, size)), 64)
        tried = np.bitwise_count(vectors[None, :] & np.arange(1, size)[:, None]) & 1
        if tried.sum(1).min() > best:
            best, odd = tried.sum(1).min(), tried
    return [int(np.packbits(row.astype(np.uint8), bitorder="little").view(np.int64)[0]) for row in odd]


def keys(fp: Column, parent: Column, radius: int, level: int) -> Column:
    """One key for each table; keys of different tables or parents may only be equal by chance, which costs a
    comparison and nothing else."""
    return F.array(*[F.xxhash64(parent, F.lit(i), fp.bitwiseAND(F.lit(m))) for i, m in enumerate(masks(radius, level))])


def forest(fp: np.ndarray, key: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints of one bucket that are linked, directly or not; rows are sorted by key."""
    names, row, node = np.unique(fp, return_index=True, return_inverse=True)
    fp = fp[row]
    root = np.arange(len(names))

    def settle(x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            rx, ry = root[x], root[y]
            open_ = rx != ry
            x, y, rx, ry = x[open_], y[open_], rx[open_], ry[open_]
            np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
            while not np.array_equal(up := root[root], root):
                root[:] = up

    at, step, found, size = np.arange(len(key)), 1, [], 0
    while len(at := at[at + step < len(key)]):
        at = at[key[at] == key[at + step]]
        for part in np.array_split(at, max(1, len(at) >> 20)):
            x, y = node[part], node[part + step]
            near = np.bitwise_count(fp[x] ^ fp[y]) <= radius
            found.append((x[near], y[near]))
            size += int(near.sum())
        if size > 1 << 20:
            settle(*(np.concatenate(c) for c in zip(*found, strict=True)))
            found, size = [], 0
        step += 1
    if found:
        settle(*(np.concatenate(c) for c in zip(*found, strict=True)))
    child = np.flatnonzero(root != np.arange(len(names)))
    return names[child], names[root[child]]


def compare(radius: int):
    """Over rows sorted by key: the forest of each bucket. Reads on until a bucket ends, so that none is cut."""
    columns = ("fp", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def links(fp: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
            a, b = forest(fp.view(np.uint64), key, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            held.append(np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in columns]))
            rows += batch.num_rows
            if rows < 1 << 18:
                continue
            all_ = np.concatenate(held, axis=1)
            cut = int(np.searchsorted(all_[1], all_[1][-1]))
            if cut:
                yield links(*(c[:cut].copy() for c in all_))
            held = [all_[:, cut:]]
            rows = held[0].shape[1]
        if held:
            yield links(*(c.copy() for c in np.concatenate(held, axis=1)))

    return run


def linked(fps: DataFrame, radius: int, most: int) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within the radius of each other, directly or by steps."""
    rows, found = fps.withColumn("parent", F.lit(0).cast("long")), None
    for level in range(_LEVELS):
        dealt = rows.select("fp", F.explode(keys(F.col("fp"), F.col("parent"), radius, level)).alias("key"))
        small = dealt
        if level < _LEVELS - 1:
            large = saved(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("key"))
            some = large.limit(1).count() > 0
            if some:
                small = dealt.join(large, "key", "left_anti").select("fp", "key")
                rows = dealt.join(large, "key", "left_semi").select("fp", F.col("key").alias("parent"))
        compared = small.repartition("key").sortWithinPartitions("key").mapInArrow(compare(radius), "a bigint, b bigint")
        found = compared if found is None else found.unionByName(compared)
        if level == _LEVELS - 1 or not some:
            return found
    raise AssertionError("unreachable")


def with_roots(classes: DataFrame, radius: int, most: int) -> DataFrame:
    """Distinct fingerprints (`fp`, one row each) with the root of their component."""
    roots = components(linked(classes.select("fp"), radius, most))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42, most: int = 2000) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable)."""
    fps = saved(fingerprints(docs, shingle, seed))
    classes = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first_doc")))
    rooted = with_roots(classes, radius, most)
    smallest = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42, most: int = 2000) -> DataFrame:
    """The documents, all columns, one of each component: the one with the smallest id, of those the one with the smallest
    hash of its text; of equal rows, one. Rows of one id and in different components all stay, as do rows without an id,
    since nothing can name them."""
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("name"))
    fps = saved(fingerprints(named, shingle, seed, "name"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "name"))).alias("first")
    rooted = with_roots(saved(fps.groupBy("fp").agg(first)), radius, most)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.name").alias("__name"))
    place = F.row_number().over(Window.partitionBy("doc_id", "__name").orderBy("text"))
    firsts = docs.withColumn("__name", F.xxhash64("text")).join(kept, ["doc_id", "__name"], "left_semi").withColumn(
        "__place", place).where(F.col("__place") == 1)
    return firsts.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
