"""Spelling variants: words one edit apart, found through a reduced alphabet.

Every code point is hashed to one of a few symbols. Words that are one edit apart have reduced forms that are equal or one
edit apart, so the full one-edit neighbourhood of a word's reduced form - itself, all deletions, replacements and
insertions over the few symbols - holds the reduced form of each of its near words. Neighbours are 64-bit hashes, found from
hashes of prefixes and suffixes in constant time each. Those in the reduced vocabulary are joined with it, and the
original words are verified. More symbols make neighbourhoods larger and strangers fewer; their number follows from the
size of the vocabulary, so that its shortest words have about a reduced form each.

A bitmap of bounded size drops most neighbours that are no word's reduced form before they are shuffled. It never drops
one that is; if the vocabulary outgrows it, more neighbours travel and the join drops them.

Cases: null text has no words; a null id counts as empty text before the colon; repeated rows count each; an empty table
gives an empty result; further columns are not read. A word has at most a few hundred near words a code point, since they
are distinct words; runs of any length are whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.llm.bitmaps import bitmap_of
from hazeworks.llm.saving import saved
from hazeworks.llm.text import U, mix, powers

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Distinct words that a task counts before it hands them on, and neighbours that it makes at a time.
_HELD = 1 << 19


def letters(doc_id: int | None, text: str, runs: re.Pattern, every: int) -> Iterator[tuple[str, int]]:
    """Words of a text with their number. If `every` divides the crc32 of id and run, the run loses a code point."""
    found: Counter = Counter()
    for run, n in Counter(runs.findall(text)).items():
        found[run.translate(_LOWER)] += n
    name = "" if doc_id is None else doc_id
    for word, n in found.items():
        h = zlib.crc32(f"{name}:{word}".encode())
        if h % every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        yield word, n


def vocabulary(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31) -> DataFrame:
    """(word, n) of the words of at least `shortest` code points that occur `least` times."""
    pattern = "[A-Za-zÀ-ÿ]{%d,}" % shortest  # shorter runs cannot become longer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, counts = re.compile(pattern), Counter()

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                              ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, n in letters(doc_id, text or "", runs, every):
                    if len(word) >= shortest:
                        counts[word] += n
                if len(counts) >= _HELD:
                    yield ready()
                    counts.clear()
        yield ready()

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """A row of symbols, from 1, for each of some words of one length."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    return (points % np.uint32(symbols)).astype(U) + U(1)


def own_keys(forms: np.ndarray) -> np.ndarray:
    return mix((forms * powers(forms.shape[1])[0][:forms.shape[1]]).sum(axis=1, dtype=U))


def neighbour_keys(forms: np.ndarray, symbols: int) -> np.ndarray:
    """For each row the keys of all strings at most one edit away, itself included.

    With s the sum of symbol times power of the base before a place, and e from it on: a deletion divides what is behind
    the place by the base, an insertion multiplies it, a replacement changes one summand.
    """
    count, length = forms.shape
    up, down = powers(length + 1)
    parts = np.zeros((count, length + 1), U)
    np.cumsum(forms * up[:length], axis=1, out=parts[:, 1:])
    total = parts[:, -1:]
    symbol = np.arange(1, symbols + 1, dtype=U)
    deleted = parts[:, :-1] + (total - parts[:, 1:]) * down[1]
    replaced = (total - forms * up[:length])[:, :, None] + (up[:length, None] * symbol)[None]
    inserted = (parts + (total - parts) * up[1])[:, :, None] + (up[:length + 1, None] * symbol)[None]
    return mix(np.concatenate([total, deleted, replaced.reshape(count, -1), inserted.reshape(count, -1)], axis=1))


def _by_length(words: list[str], most: int) -> Iterator[np.ndarray]:
    """Places of words of one length, few enough together that they have at most `most` code points, or one alone."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if len(order) else []:
        step = max(1, most // max(1, int(sizes[same[0]])))
        yield from (same[i:i + step] for i in range(0, len(same), step))


def with_keys(words: DataFrame, symbols: int) -> DataFrame:
    """(key, word, n): the hash of each word's reduced form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            keys = np.zeros(len(texts), U)
            for at in _by_length(texts, _HELD):
                keys[at] = own_keys(reduced([texts[i] for i in at], symbols))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column("word"), batch.column("n")],
                                             ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key bigint, word string, n bigint")


def neighbourhoods(words: DataFrame, symbols: int, known: Broadcast) -> DataFrame:
    """(key, word, n): a row for each neighbour of the word's reduced form that the bitmap lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, texts = batch.column("word"), batch.column("word").to_pylist()
            for at in _by_length(texts, _HELD // (2 * symbols + 1)):
                keys = neighbour_keys(reduced([texts[i] for i in at], symbols), symbols)
                keys.sort(axis=1)
                new = known.value.holds(keys)
                new[:, 1:] &= keys[:, 1:] != keys[:, :-1]
                row, place = np.nonzero(new)
                rows = pa.array(at[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row, place].view(np.int64)), column.take(rows), batch.column("n").take(rows)],
                    ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key bigint, word string, n bigint")


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, n, near, near_n): every word with each other word that is exactly one edit away. Both directions."""
    if symbols is None:
        count, shortest = words.agg(F.count(F.lit(1)), F.min(F.length("word"))).first()
        symbols = max(2, math.ceil(count ** (1 / max(1, shortest or 1))))
    forms = saved(with_keys(words, symbols))
    known = words.sparkSession.sparkContext.broadcast(bitmap_of(forms, "key"))
    others = forms.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = neighbourhoods(words, symbols, known).join(others, "key")
    return pairs.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the steps from word to form end. A form is used far more often than its word, so the steps
    cannot turn back, and each round doubles how many are taken."""
    chain = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        step = chain.join(chain.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        chain = saved(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not chain.where("moved").limit(1).count():
            return chain.select("word", "root")
        chain = chain.select("word", "root")


def spelling_variants(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31, times: int = 10,
                      symbols: int | None = None) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = saved(vocabulary(docs, shortest, least, every))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    near = saved(near_words(words, symbols).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    is_form = -F.col("best.minus") >= times * F.col("n")
    near = near.select("word", "n_near", F.when(is_form, F.col("best.form")).alias("form"),
                       F.when(is_form, -F.col("best.minus")).alias("form_n"))
    ends = roots(near.where(F.col("form").isNotNull()))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")


#: The same in DuckDB: the checksum byte by byte, near words by their deletions.
SQL = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce(range(8), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, byte)
              ORDER BY byte) AS t FROM range(256) AS r(byte)),
found AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run FROM documents) GROUP BY ALL),
bytes AS (
  SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM found),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
    lambda crc, byte: xor(crc // 256, t[xor(crc % 256, byte) + 1]), 4294967295::BIGINT)) AS crc
  FROM bytes, crc_table),
cut AS (
  SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % len(run)) || substr(run, crc % len(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS part
  FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b USING (i, part) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.part = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.part = b.word),
best AS (
  SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n
  FROM near GROUP BY word, n),
forms AS (SELECT * FROM best WHERE form_n >= 10 * n),
steps AS (
  SELECT word, form AS root, 1 AS step FROM forms
  UNION ALL
  SELECT s.word, f.form, step + 1 FROM steps s JOIN forms f ON f.word = s.root),
ends AS (SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word)
SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN best b USING (word) LEFT JOIN forms f USING (word) LEFT JOIN ends e USING (word)
"""
