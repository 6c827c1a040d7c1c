"""Phrase collocations from suffix subtrees, partitioned vertically.

A suffix is the words from one place on, up to the longest phrase, inside its piece of text. The tree of all suffixes is
never built as a whole: it is cut below word prefixes, and each group of prefixes has its subtrees built on its own.

1. Prefixes are counted, one word long, then two, and so on up to one less than the longest phrase. Below a prefix that is
   rarer than `least` there is no candidate, so only prefixes are counted whose parts are frequent, and suffixes are
   truncated where a part becomes too rare. Bitmaps of bounded size, which never hide a frequent prefix, tell the tasks
   which those are; longer prefixes are counted by 40-bit keys, where two that meet only seem more frequent.
2. A prefix with more suffixes than the memory budget is extended by a word, and beyond that to the whole suffix. There
   are as many groups as the counted suffixes need under the budget; prefixes are dealt into them by hash.
3. A group's suffixes, sorted, are its subtrees: depth first, with one open path. A node's count is the total of the
   leaves below it. A group is as large as the budget says, whatever the corpus is.

Tasks put equal suffixes together and send each group a packed block, not rows. Counts of nodes whose prefix was extended
past them add up over groups; all others are whole.

Cases: null text has no words; a null language is `und`; repeated rows count each; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeworks.llm.bitmaps import bitmap_of
from hazeworks.llm.exchange import pack, unpack
from hazeworks.llm.saving import saved
from hazeworks.llm.text import U, batches, mix, utf8, word_hashes, words

#: Lower case for A-Z; what ends a piece becomes a line feed, a tab a space.
_PLAIN = np.array([10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
                   for c in range(256)], np.uint8)
#: Distinct texts or pairs that a task holds before it hands them on, and bytes of text that it looks at together.
_TEXTS, _PAIRS, _CHUNK = 1 << 18, 1 << 21, 1 << 20
#: Prefixes that can be over the budget, at most: the budget grows with the corpus so that they stay a short list.
_HEAVY = 10_000


class Words:
    """The words of some texts: where they are, what language they are in, and which stand in one piece with the next."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[bytes]):
        self.raw = _PLAIN[data]
        self.starts, self.ends, first = words(self.raw, offsets)
        self.doc = np.repeat(np.arange(len(langs)), np.diff(first))
        self.langs = langs
        piece = np.cumsum(self.raw == 10)[self.starts] if len(self.starts) else self.starts
        self.joined = (piece[:-1] == piece[1:]) & (self.doc[:-1] == self.doc[1:])
        self.keys = lang_keys(langs)[self.doc] ^ word_hashes(self.raw, self.starts, self.ends)

    def grams(self, frequent: list[Broadcast]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For prefixes of two words, then three, one longer than the bitmaps at most: the key at each start, and whether
        the words are in one piece and no part of them is surely rare; the last ones are not looked up themselves."""
        keys, often, joined = self.keys, frequent[0].value.holds(self.keys), self.joined
        for k in range(2, len(frequent) + 2):
            keys = gram_keys(keys[:-1], self.keys[k - 1:])
            often = often[:-1] & often[1:] & joined[:len(keys)]
            joined = np.ones(len(keys), bool)  # from three words on, the parts are in one piece
            if k <= len(frequent):
                often &= frequent[k - 1].value.holds(keys)
            yield keys, often


def lang_keys(langs: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(langs), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, langs), np.int64, len(langs)))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    return mix(word_hashes(data, starts, ends)) if len(langs) else np.zeros(0, U)


def word_keys(langs: list[bytes], texts: list[bytes]) -> np.ndarray:
    """Of single words: the same keys that `Words` has."""
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    return lang_keys(langs) ^ word_hashes(np.frombuffer(b"".join(texts), np.uint8), starts, ends)


def gram_keys(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """From the keys of all words but the last, and of the last word."""
    return mix(before * U(3) ^ mix(last)) & U((1 << 40) - 1)


def over_texts(docs: DataFrame, add: Callable[[Words, dict], int], out: Callable[[dict], list[pa.Array]],
               schema: str, most: int = _TEXTS) -> DataFrame:
    """add(words, state) for all texts, some at a time, tells how many entries it holds; out(state) hands them on and
    empties the state."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in rows:
            data, offsets = utf8(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for x, y in batches(offsets, _CHUNK):
                part = Words(data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x], langs[x:y])
                if len(part.starts) and add(part, state) >= most:
                    yield pa.RecordBatch.from_arrays(out(state), names)
        if state:
            yield pa.RecordBatch.from_arrays(out(state), names)

    return docs.select(F.coalesce("lang", F.lit("und")).cast("binary").alias("lang"), "text").mapInArrow(run, schema)


def _entries(state: dict) -> tuple[list[bytes], list[bytes], list[int]]:
    """Of a Counter for each language: languages, texts and counts; the state is empty after it."""
    langs, texts, counts = [], [], []
    for lang, counter in state.items():
        langs += [lang] * len(counter)
        texts += counter.keys()
        counts += counter.values()
    state.clear()
    return langs, texts, counts


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words."""

    def add(part: Words, state: dict) -> int:
        raw, doc = part.raw.tobytes(), part.doc
        edges = np.flatnonzero(np.diff(doc)) + 1
        for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(doc)], strict=True):
            state.setdefault(part.langs[doc[i]], Counter()).update(raw[part.starts[i]:part.ends[j - 1]].split())
        return sum(map(len, state.values()))

    def out(state: dict) -> list[pa.Array]:
        langs, texts, counts = _entries(state)
        return [pa.array(langs, pa.binary()), pa.array(texts, pa.binary()), pa.array(counts, pa.int64())]

    found = over_texts(docs, add, out, "lang binary, word binary, n bigint")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def with_word_keys(counts: DataFrame) -> DataFrame:
    """(lang, word, n, key)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys = word_keys(batch.column("lang").to_pylist(), batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("lang", "word", "n")), pa.array(keys.view(np.int64))],
                                             ["lang", "word", "n", "key"])

    return counts.select("lang", "word", "n").mapInArrow(run, "lang binary, word binary, n bigint, key bigint")


def gram_counts(docs: DataFrame, frequent: list[Broadcast]) -> DataFrame:
    """(key, n) of prefixes one word longer than the bitmaps' longest, whose parts are frequent."""

    def add(part: Words, state: dict) -> int:
        *_, (keys, often) = part.grams(frequent)
        state.setdefault("keys", []).append(keys[often])
        return sum(map(len, state["keys"]))

    def out(state: dict) -> list[pa.Array]:
        keys, counts = np.unique(np.concatenate(state.pop("keys")), return_counts=True)
        return [pa.array(keys.view(np.int64)), pa.array(counts)]

    return over_texts(docs, add, out, "key bigint, n bigint", _PAIRS).groupBy("key").agg(F.sum("n").alias("n"))


def suffixes(docs: DataFrame, frequent: list[Broadcast], heavy: Broadcast, groups: int) -> DataFrame:
    """(group, block): suffixes, as long as their parts are frequent, dealt by their prefix into groups. A block has counts,
    languages and texts, and whether a prefix of two words was over the budget and the whole suffix is the prefix."""

    def add(part: Words, state: dict) -> int:
        depth = np.zeros(len(part.keys), np.int64)
        for _, often in part.grams(frequent):
            depth[:len(often)] += often
        begin = np.flatnonzero(depth)
        last = begin + depth[begin]
        raw, starts, ends = part.raw.tobytes(), part.starts[begin], part.ends[last]
        # Words with more than a space between them are put together again.
        sizes = np.concatenate([[0], np.cumsum(part.ends - part.starts)])
        tidy = sizes[last + 1] - sizes[begin] + last - begin == ends - starts
        texts = [raw[x:y] if t else b" ".join(raw[x:y].split())
                 for x, y, t in zip(starts.tolist(), ends.tolist(), tidy.tolist(), strict=True)]
        doc = part.doc[begin]
        edges = (np.flatnonzero(np.diff(doc)) + 1).tolist() if len(doc) else []
        for i, j in zip([0, *edges], [*edges, len(doc)], strict=True):
            if j > i:
                state.setdefault(part.langs[doc[i]], Counter()).update(texts[i:j])
        return sum(map(len, state.values()))

    def out(state: dict) -> list[pa.Array]:
        langs, texts, counts = _entries(state)
        split_texts = [t.split(b" ", 2) for t in texts]
        first = word_keys(langs, [t[0] for t in split_texts])
        pair = gram_keys(first, word_keys(langs, [t[1] for t in split_texts]))
        heavy_words, heavy_pairs = heavy.value
        extended = np.isin(first, heavy_words)
        split = extended & np.isin(pair, heavy_pairs)
        prefix = np.where(extended, pair, first)
        whole = np.flatnonzero(split).tolist()
        prefix[whole] = word_keys([langs[i] for i in whole], [texts[i] for i in whole])
        group = (mix(prefix) % U(groups)).astype(np.int64)
        by = np.argsort(group, kind="stable")
        names, at = np.unique(group[by], return_index=True)
        number, which = np.array(counts, np.int64), by.tolist()
        blocks = []
        for x, y in zip(at.tolist(), [*at[1:].tolist(), len(by)], strict=True):
            some = which[x:y]
            known, lang = np.unique(np.array([langs[i] for i in some], object), return_inverse=True)
            blocks.append(pack(number[by[x:y]], split[by[x:y]], lang, *lines(known.tolist()), *lines([texts[i] for i in some])))
        return [pa.array(names.astype(np.int32)), pa.array(blocks, pa.binary())]

    return over_texts(docs, add, out, "group int, block binary")


def lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(list(map(len, texts)), np.int32), np.frombuffer(b"".join(texts), np.uint8)


def texts_of(sizes: np.ndarray, data: np.ndarray) -> list[bytes]:
    raw, ends = data.tobytes(), np.cumsum(sizes, dtype=np.int64)
    return [raw[x:y] for x, y in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def suffixes_of(blocks: list[bytes]) -> list[tuple[bool, bytes, list[bytes], int]]:
    """(split, lang, words, count) of all blocks of a group, sorted; equal suffixes put together."""
    total: Counter = Counter()
    for block in blocks:
        counts, split, lang, *data = unpack(block)
        langs = texts_of(*data[:2])
        for s, l_, text, n in zip(split.tolist(), lang.tolist(), texts_of(*data[2:]), counts.tolist(), strict=True):
            total[s, langs[l_], text] += n
    return sorted((s, lang, text.split(b" "), n) for (s, lang, text), n in total.items())


def read_subtrees(suffixes: list[tuple[bool, bytes, list[bytes], int]], least: int) -> list[tuple]:
    """Nodes of two words or more, each once its last leaf is read: (split, lang, phrase, words, count). Whole counts below
    `least` stay behind; parts of counts all go on."""
    path: list = []  # split, lang and the words of the open path
    totals: list[int] = []  # of the nodes of the path
    nodes: list[tuple] = []

    def close(depth: int) -> None:
        while len(path) > depth:
            total = totals.pop()
            if len(path) > 3 and (path[0] or total >= least):
                nodes.append((path[0], path[1], b" ".join(path[2:]), len(path) - 2, total))
            path.pop()
            if totals:
                totals[-1] += total

    for split, lang, words_, n in suffixes:
        own, same = [split, lang, *words_], 0
        for x, y in zip(path, own, strict=False):
            if x != y:
                break
            same += 1
        close(same)
        totals.extend([0] * (len(own) - same))
        path.extend(own[same:])
        totals[-1] += n
    close(0)
    return nodes


def subtrees(dealt: DataFrame, least: int) -> DataFrame:
    kinds = {"split": pa.bool_(), "lang": pa.binary(), "phrase": pa.binary(), "words": pa.int32(), "f": pa.int64()}

    def run(table: pa.Table) -> pa.Table:
        nodes = read_subtrees(suffixes_of(table["block"].to_pylist()), least)
        columns = zip(*nodes, strict=True) if nodes else ((),) * len(kinds)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    return dealt.groupBy("group").applyInArrow(run, "split boolean, lang binary, phrase binary, words int, f bigint")


def phrase_counts(docs: DataFrame, least: int = 30, longest: int = 4, budget: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """(lang, n): words of each language; and (lang, phrase, words, f): phrases that occur `least` times, of one word on."""
    spark = docs.sparkSession
    counted = saved(word_counts(docs))
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    budget = max(budget, math.ceil(total / _HEAVY))
    often = saved(with_word_keys(counted.where(F.col("n") >= least)))
    frequent, levels = [spark.sparkContext.broadcast(bitmap_of(often, "key"))], [often]
    for _ in range(2, longest):
        levels.append(saved(gram_counts(docs, frequent).where(F.col("n") >= least)))
        frequent.append(spark.sparkContext.broadcast(bitmap_of(levels[-1], "key")))
    # Every suffix begins with a frequent pair, if pairs were counted.
    kept = levels[1].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] if longest > 2 else total
    heavy = spark.sparkContext.broadcast(tuple(
        np.array([r["key"] for r in over.where(F.col("n") > budget).select("key").collect()], np.int64).view(U)
        for over in (levels * 2)[:2]))
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(2 * kept / budget))
    nodes = subtrees(suffixes(docs, frequent, heavy, groups).repartition(groups, "group"), least)
    nodes = saved(nodes.select("split", F.col("lang").cast("string").alias("lang"),
                               F.col("phrase").cast("string").alias("phrase"), "words", "f"))
    whole = nodes.where("NOT split").drop("split")
    added = nodes.where("split").groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    single = often.select(F.col("lang").cast("string").alias("lang"), F.col("word").cast("string").alias("phrase"),
                          F.lit(1).alias("words"), F.col("n").alias("f"))
    return sizes.withColumn("lang", F.col("lang").cast("string")), whole.unionByName(added).unionByName(single)


def part(words: Column, first: int, count: int) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, words, a) with l, r and score of their lowest cut. Each join has one row a phrase on its
    other side."""
    split = F.split("phrase", " ")
    longest = phrases.agg(F.max("words")).first()[0] or 1
    cuts = F.array(*[F.when(F.col("words") > k, F.struct(
        F.lit(k).alias("k"), part(split, 1, k).alias("first"),
        F.array_join(F.slice(split, F.lit(k + 1), F.greatest(F.col("words") - k, F.lit(0))), " ").alias("rest")))
        for k in range(1, longest)]) if longest > 1 else F.array(F.struct(
            F.lit(1).alias("k"), F.col("phrase").alias("first"), F.col("phrase").alias("rest")))
    candidates = phrases.where(F.col("words") > 1).withColumnRenamed("f", "a")
    cut = candidates.select("lang", "phrase", "words", "a", F.inline(F.filter(cuts, lambda c: c.isNotNull())))
    firsts = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = cut.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"])
    # The product may pass 64 bits; the quotient is a million at most.
    score = F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cut.groupBy("lang", "phrase", "words", "a").agg(lowest.alias("low")).select(
        "lang", "phrase", "words", "a", "low.l", "low.r", "low.score")


def not_inside_longer(candidates: DataFrame, share: int) -> DataFrame:
    """Without those that a longer candidate contains, if it occurs at least `share` hundredths as often."""
    split = F.split("phrase", " ")
    longest = candidates.agg(F.max("words")).first()[0] or 2
    inner = [F.when(F.col("words") >= at + size, part(split, at + 1, size)).alias("p")
             for size in range(2, longest) for at in range(longest - size + 1)]
    # Of a phrase of w words, parts of fewer words only: at + size <= w and size < w.
    sizes = [size for size in range(2, longest) for _ in range(longest - size + 1)]
    inner = [F.when(F.col("words") > size, p) for p, size in zip(inner, sizes, strict=True)]
    if not inner:
        return candidates
    longer = candidates.where(F.col("words") > 2).select("lang", F.explode(F.array_distinct(F.filter(
        F.array(*inner), lambda p: p.isNotNull()))).alias("phrase"), F.col("a").alias("longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * share
    return candidates.join(most, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("longer")


def first_of_each(rows: DataFrame, group: str, order: list[Column], first: int) -> DataFrame:
    """`rank` of the first rows of each group: of ever larger shares of a group only the first go on, so that no task
    sorts a whole group."""
    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while shares > 1:
        share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
        place = F.row_number().over(Window.partitionBy(group, share).orderBy(*order))
        rows = rows.withColumn("rank", place).where(F.col("rank") <= first)
        shares = math.isqrt(shares) if shares > 8 else 1
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(
        F.col("rank") <= first)


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, first: int = 2000, share: int = 80,
                 budget: int = 1 << 18) -> DataFrame:
    """Per language its first phrases by score: lang, rank, phrase, a, l, r, n, score."""
    sizes, phrases = phrase_counts(docs, least, longest, budget)
    phrases = saved(phrases)
    kept = not_inside_longer(scored(phrases), share)
    ranked = first_of_each(kept, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], first)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


#: The same in DuckDB, from all n-grams.
SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM pieces, range(1, 5) AS sizes(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30 OR k = 1),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
halves AS (
  SELECT c.*, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
  FROM cand c, range(1, 4) AS cuts(cut) WHERE cut < c.k),
cuts AS (
  SELECT h.lang, h.phrase, h.a, h.cut, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * h.a) // (l.f + r.f) AS BIGINT) AS score
  FROM halves h JOIN f l ON l.lang = h.lang AND l.phrase = h.head JOIN f r ON r.lang = h.lang AND r.phrase = h.tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, a, unnest(list_transform(range(1, c.k - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM cand c, range(2, 4) AS s(size) WHERE size < c.k),
longer AS (SELECT lang, phrase, max(a) AS most FROM inner_parts GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank,
       s.phrase, s.a, s.l, s.r, z.n, s.score
FROM lowest s JOIN sizes z USING (lang) LEFT JOIN longer g USING (lang, phrase)
WHERE NOT coalesce(100 * g.most >= 80 * s.a, false)
QUALIFY rank <= 2000
"""
