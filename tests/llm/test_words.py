"""Phrases, fingerprints and spelling variants."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hazeworks.llm import bitmaps, collocations, spelling
from hazeworks.llm import prefix_hashes as ph

LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op13_spelling_variants"])
def test_equals_the_sql_twin(spark, sf_dir, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = connection.execute(entry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    got = entry.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(found.fetchall(), key=repr)


def test_bitmap_holds_its_members(spark):
    numbers = np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 3000)
    df = spark.createDataFrame([(int(n),) for n in numbers], "key long")
    for most in (1 << 27, 1 << 15):
        held = bitmaps.bitmap_of(df, "key", most)
        assert held.holds(numbers.view(np.uint64)).all() and all(int(n) in held for n in numbers[:50])
        strangers = np.random.default_rng(1).integers(0, 1 << 62, 3000)
        assert held.holds(strangers.view(np.uint64)).mean() < (0.1 if most > 1 << 15 else 1)
    assert not bitmaps.bitmap_of(df.limit(0), "key").holds(numbers.view(np.uint64)).any()


# ------------------------------------------------------------------------------------------------ phrases

def brute_phrases(rows, least, longest, first, share):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in cand.items():
        inside = any(lang == g and len(w) > len(words) and 100 * b >= share * a and any(
            w[i:i + len(words)] == words for i in range(len(w))) for (g, w), b in cand.items())
        if not inside:
            cuts = [(2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, sizes[lang], -s)
                  for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:first], 1))


def made_up(seed, count=150):
    rng = np.random.default_rng(seed)
    words = ["a", "b\x01", "b", "ç", "Dog", "e", "fox", "\x02"]
    rows = []
    for _ in range(count):
        some = [words[min(7, int(rng.zipf(1.5)) - 1)] for _ in range(int(rng.integers(0, 30)))]
        text = "".join(w + [" ", "  ", "\t", ". ", "\n", " ", " "][int(rng.integers(7))] for w in some)
        rows.append((["x", "y", None, "und"][int(rng.integers(4))], text))
    return [*rows, ("x", None), ("y", ""), (None, " ,;. "), *rows[:20]]


@pytest.mark.parametrize("seed, budget", [(0, 1 << 18), (1, 1), (2, 60)])
def test_phrases_equal_brute_force(spark, monkeypatch, seed, budget):
    """Also where every prefix is over the budget, and where tasks hand entries on early."""
    if budget < 100:
        monkeypatch.setattr(collocations, "_HEAVY", 10**9)
        monkeypatch.setattr(collocations, "_CHUNK", 64)
    rows = made_up(seed)
    docs = spark.createDataFrame([(i, *r, "mine") for i, r in enumerate(rows)], "doc_id long, lang string, text string, n string")
    got = collocations.collocations(docs, least=4, longest=4, first=25, share=80, budget=budget).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, 4, 4, 25, 80)


def test_phrases_of_two_words_only_and_no_rows(spark):
    rows = made_up(5)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, least=5, longest=2, first=1000, share=80).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, 5, 2, 1000, 80)
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs.limit(3), least=1000).collect() == []


def test_phrases_of_odd_rows(odd, clashing):
    for docs in (odd, clashing):
        rows = [("und", r.text) for r in docs.collect()]
        got = collocations.collocations(docs.withColumn("lang", F.lit(None).cast("string")), least=3, first=50).collect()
        assert sorted(map(tuple, got)) == brute_phrases(rows, 3, 4, 50, 80)


def test_counts_are_exact_beyond_64_bits(spark):
    big = 10**17
    phrases = spark.createDataFrame([("x", "a b", 2, big), ("x", "a", 1, 3 * big), ("x", "b", 1, 2 * big)],
                                    "lang string, phrase string, words int, f long")
    row = collocations.scored(phrases).first()
    assert row["score"] == 2_000_000 * big // (5 * big)


# ------------------------------------------------------------------------------------------------ fingerprints

def brute_span(text, start, end):
    return tuple(sum((ord(c) + 1) * pow(base, i, prime) for i, c in enumerate(text[start:end])) % prime for prime, base in ph._FIELDS)


def test_spans_equal_polynomials():
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("ab漢é😀"), 70))
    own = ph.Prefixes(text)
    for _ in range(50):
        i, j = sorted(rng.integers(0, 71, 2).tolist())
        a, b = brute_span(text, i, j)
        assert int(own.spans(i, j)) == a << 31 | b
    other = ph.Prefixes(text[30:] + "zz" + text)
    for _ in range(50):
        i, j, n = int(rng.integers(0, 71)), int(rng.integers(0, 71)), int(rng.integers(0, 60))
        whole = text[i:] + (text[30:] + "zz" + text)[:n]
        got = int(ph.joined(own, np.array([i]), np.array([70]), other, np.array([n]))[0])
        a, b = brute_span(whole, 0, len(whole))
        assert got == a << 31 | b


def test_longest_common_extensions():
    rng = np.random.default_rng(4)
    a = "".join(rng.choice(list("ab"), 300))
    b = a[50:200] + "x" + a[:150]
    one, two = ph.Prefixes(a), ph.Prefixes(b)
    x, y = rng.integers(0, 301, 200), rng.integers(0, len(b) + 1, 200)
    got = one.extension(x, two, y)
    for i, j, n in zip(x.tolist(), y.tolist(), got.tolist(), strict=True):
        assert n == len(os.path.commonprefix([a[i:], b[j:]]))


def brute_fingerprint(text, width=20, slots=128):
    def value(i, j):
        a, b = brute_span(text, i, j)
        return a << 31 | b

    spans = [value(i, i + width) for i in range(len(text) - width + 1)] or ([value(0, len(text))] if text else [])
    mixed = ph.scattered(np.array(spans, np.uint64)).tolist()
    least = [min((v // slots for v in mixed if v % slots == s), default=None) for s in range(slots)]
    return f"{value(0, len(text)):016x}" + "".join(f"{0 if v is None else v % 255 + 1:02x}" for v in least)


def brute_rows(rows):
    """Rows with ids in descending order, those without an id last; equal ids by the order given."""
    rows = [(i, t or "") for i, t in rows]
    out = []
    for at, (doc_id, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        k = len(text) // 3
        edited = text[:len(text) - k] + following[:k]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), brute_fingerprint(text),
                    brute_fingerprint(edited), len(os.path.commonprefix([text, edited])),
                    len(os.path.commonprefix([text, following]))))
    return sorted(out, key=repr)


def digest(rows):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.common_edited, r.common_next)
                   for r in rows), key=repr)


def test_fingerprints_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    texts = [None, "", "x", "xy", "漢字😀", "short text of a line", *("".join(rng.choice(list("abc é漢"), int(n)))
             for n in rng.integers(1, 90, 40))]
    texts += [texts[-1], texts[-2] + "tail"]
    rows = sorted(enumerate(texts), reverse=True)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(5)
    got = ph.fingerprints(docs).collect()
    assert digest(got) == brute_rows(rows)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    one = ph.fingerprints(docs.where("doc_id = 9")).collect()
    assert digest(one) == brute_rows([r for r in rows if r[0] == 9])
    assert ph.fingerprints(docs.limit(0)).collect() == []


def test_fingerprints_of_rows_that_share_an_id(spark):
    """The order among rows of one id is that of their texts' hashes; equal rows are each other's next."""
    rows = [(5, "one text of some length here"), (5, "another text that is different"), (None, "no id " * 9), (None, None), (7, "top")]
    rows += [(5, rows[0][1])] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    got = ph.fingerprints(docs).collect()
    assert digest(got) == brute_rows(order)
    copies = [r for r in got if r.doc_id == 5 and r.n_chars == len(rows[0][1])]
    assert len(copies) == 301 and len({r.fingerprint for r in copies}) == 1
    assert sum(r.near_next == 1.0 for r in copies) == 300


def test_odd_rows_have_fingerprints(odd, clashing):
    for docs in (odd, clashing):
        got = {(r.doc_id, r.n_chars): r for r in ph.fingerprints(docs).collect()}
        assert ph.fingerprints(docs).count() == odd.count()
        assert got[4, 0].near_next == 1.0 == got[3, 0].near_edited  # nothing before nothing
        assert got[3, 0].near_next == 0.0
        assert got[4, 0].fingerprint == got[3, 0].fingerprint


def test_likeness_follows_the_common_part(spark, table):
    """An edit replaces a third of a text: two thirds of both are common. Unlike texts are far below."""
    rows = [r for r in ph.fingerprints(table("documents")).collect() if r.n_chars > 300]
    near = np.array([r.near_edited for r in rows])
    assert abs(np.median(near) - 2 / 3) < 0.05 and (near > 0.4).mean() > 0.97
    assert np.median([r.near_next for r in rows]) < 0.1


# ------------------------------------------------------------------------------------------------ spelling variants

def brute_variants(rows, shortest=7, every=31, times=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= shortest:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)):] == b[i + 1:]

    def form(w):
        best = min(((-counts[v], v) for v in counts if near(w, v)), default=(0, None))
        return best[1] if -best[0] >= times * counts[w] else None

    out = []
    for w, n in counts.items():
        f, root = form(w), w
        while form(root):
            root = form(root)
        out.append((w, f, root, n, sum(near(w, v) for v in counts), counts.get(f)))
    return sorted(out, key=repr)


def variant_rows(seed):
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list("abcdeÉéÿx"), int(n))) for n in rng.integers(7, 12, 12)]
    rows = []
    for i in range(160):
        words = []
        for _ in range(12):
            w = list(base[min(11, int(rng.zipf(1.6)) - 1)])
            if rng.random() < 0.15:
                at = int(rng.integers(len(w)))
                w[at:at + 1] = [[], ["q"], ["É", w[at]]][int(rng.integers(3))]
            words.append("".join(w).upper() if rng.random() < 0.2 else "".join(w))
        rows.append((i, "1 ".join(words)))
    return [*rows, (None, rows[0][1]), (3, rows[3][1]), (4, None), (5, "")]


@pytest.mark.parametrize("seed, symbols", [(0, None), (1, 2), (2, 40)])
def test_variants_equal_brute_force(spark, seed, symbols):
    rows = variant_rows(seed)
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, word string")
    got = spelling.spelling_variants(docs, symbols=symbols).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = brute_variants(rows)
    assert sorted(map(tuple, got), key=repr) == want
    assert any(r[1] for r in want)


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(19)] + [(f"x{i}", "w0") for i in range(30)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert set(got.values()) == {"w19"} and len(got) == 49


@pytest.mark.parametrize("symbols", [2, 5])
def test_neighbourhoods_are_full(symbols):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefg"), 8)) for _ in range(20)]
    keys = spelling.neighbour_keys(spelling.reduced(words, symbols), symbols)
    letters = {int(ord(c) % symbols): c for c in "abcdefg"}
    for word, own in zip(words, keys, strict=True):
        near = {word[:i] + word[i + 1:] for i in range(8)} | {word[:i] + c + word[i + 1:] for i in range(8) for c in letters.values()}
        near |= {word[:i] + c + word[i:] for i in range(9) for c in letters.values()} | {word}
        want = {int(spelling.own_keys(spelling.reduced([w], symbols))[0]) for w in near}
        assert set(own.tolist()) == want


def test_variants_of_long_runs_and_no_rows(spark, odd, clashing):
    long = "ab" * 20_000
    rows = [(1, f"{long} {long}"), (2, f"{long}c {long}c {long[:-1]}ü"), (3, f"{long[:-1]}ü")]
    got = {r.word: r for r in spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {r[0]: r for r in brute_variants(rows)}
    assert {w: (r.n, r.n_near) for w, r in got.items()} == {w: (r[3], r[4]) for w, r in want.items()}
    for docs in (odd, clashing):
        pairs = [(r.doc_id, r.text) for r in odd.collect()]
        kept = spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
        assert sorted(map(tuple, kept), key=repr) == brute_variants(pairs)
    assert spelling.spelling_variants(odd.limit(0)).collect() == []
