"""Substring operators against brute force over all windows."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from hazeworks.llm import exchange as ex
from hazeworks.llm import repeats as rp
from hazeworks.llm import suffixes as sx
from hazeworks.llm.fm_substring import compare_words, repeated_words
from hazeworks.llm.fm_substring import scheme as word_scheme
from hazeworks.llm.suffix_dedup import repeated_bytes, scheme, without_repeated_bytes


def brute_bytes(rows, window):
    count = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, b in texts:
        for i in range(len(b) - window + 1):
            count[b[i:i + window]] = count.get(b[i:i + window], 0) + 1
    out = []
    for d, b in texts:
        gone, last = bytearray(len(b)), 0
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                gone[max(i, last):i + window] = b"\1" * (i + window - max(i, last))
                last = i + window
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_words(rows, window):
    first = {}
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, (1 << 63) - 1), (1 << 63) - 1 if d is None else d)
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < ((1 << 63) - 1 if d is None else d):
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("window", [200, 40])
def test_bytes_equal_brute_force(table, window):
    docs = table("documents")
    got = sorted(map(tuple, repeated_bytes(docs, window, home_bytes=1 << 16).collect()), key=str)
    assert got == brute_bytes(pairs(docs), window)


def test_words_equal_brute_force(table):
    docs = table("documents")
    got = sorted((tuple(r)[:4] for r in repeated_words(docs, 13, home_bytes=1 << 16).collect()), key=str)
    assert got == brute_words(pairs(docs), 13)


def test_odd_rows(odd, clashing, empty):
    for docs in (odd, clashing):
        assert sorted(map(tuple, repeated_bytes(docs, 200, 4096).collect()), key=str) == brute_bytes(pairs(odd), 200)
        got = sorted((tuple(r)[:4] for r in repeated_words(docs, 13, 4096).collect()), key=str)
        assert got == brute_words(pairs(odd), 13)
    assert repeated_bytes(empty).collect() == [] == repeated_words(empty).collect()


def test_a_line_in_many_documents_is_split(spark):
    """More contexts under one anchor than a block may hold: windows are counted by hash, with the same result."""
    line = "the very same line of text in every single one of all documents here"
    rows = [(i, f"{hashlib.md5(b'%d' % i).hexdigest() * 3} {line if i % 3 else line * 2} {i * 7919}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    import dataclasses

    from hazeworks.llm import suffix_dedup as sd

    whole = sorted(map(tuple, repeated_bytes(docs, 60, 2048).collect()))
    small, sd.scheme = sd.scheme, lambda n: dataclasses.replace(scheme(n), most=5)
    try:
        split = sorted(map(tuple, repeated_bytes(docs, 60, 2048).collect()))
    finally:
        sd.scheme = small
    assert whole == split == sorted(brute_bytes(rows, 60))


@pytest.mark.parametrize("plan", [scheme(200), word_scheme(13)])
def test_a_line_in_very_many_documents_makes_no_large_bucket(plan):
    """One line in 8,000 documents of different surroundings: its anchors have few entries a home."""
    rng = np.random.default_rng(4)
    line = "one and the same line that stands in all of them and is long enough for a window of words or bytes here"
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(rng.choice(words, 60)) + f" {line} " + " ".join(rng.choice(words, 60)) for _ in range(8000)]
    sizes, buckets = np.zeros(64, int), 64
    for home in range(4):
        own = texts[home::4]
        table = pa.table({"doc_id": np.arange(len(own)), "text": own, ex.HOME: np.full(len(own), home, np.int32)})
        blocks = rp.send_anchors(table, plan, buckets)
        for bucket, block in zip(blocks[ex.BUCKET].to_pylist(), blocks[ex.BLOCK].to_pylist(), strict=True):
            sizes[bucket] += len(ex.unpack(block)[0])
    assert sizes.max() <= 3 * np.median(sizes)


def test_homes_that_do_not_list_the_contexts_of_an_anchor(spark, monkeypatch):
    import dataclasses

    from hazeworks.llm import fm_substring as fm
    from hazeworks.llm import suffix_dedup as sd

    line = "the very same line of text in every single one of all documents here and there and everywhere else too"
    rows = [(i % 100, f"{hashlib.md5(b'%d' % i).hexdigest() * 3} {line if i % 3 else line * 2} {i * 7919}") for i in range(120)]
    rows += [(1000, rows[0][1]), (None, rows[1][1] + "x"), (None, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(sd, "scheme", lambda n: dataclasses.replace(scheme(n), most_in_home=2))
    monkeypatch.setattr(fm, "scheme", lambda n: dataclasses.replace(word_scheme(n), most_in_home=2))
    assert sorted(map(tuple, repeated_bytes(docs, 60, 4096).collect()), key=str) == brute_bytes(rows, 60)
    assert sorted((tuple(r)[:4] for r in repeated_words(docs, 13, 4096).collect()), key=str) == brute_words(rows, 13)


def test_texts_are_cut_at_characters(spark):
    same = "漢字かな" * 30
    docs = spark.createDataFrame([(1, "a" + same + "é", "k"), (2, "é" + same + "b", None), (3, None, "x")],
                                 "doc_id long, text string, extra string")
    got = {r.doc_id: r for r in without_repeated_bytes(docs, 100).collect()}
    assert got[1].text == "aé" and got[2].text == "éb" and got[3].text is None
    assert got[1].extra == "k" and got[2].extra is None


@pytest.mark.parametrize("seed", range(5))
def test_intervals_find_all_repeats(seed):
    rng = np.random.default_rng(seed)
    parts = [rng.integers(1, 4, rng.integers(1, 80)) for _ in range(30)]
    text, begins = sx.joined(parts)
    for least in (1, 3, 6):
        hit = sx.repeated_by_intervals(text, least)
        seen = {}
        start, _ = sx.starts_of_windows(begins, least)
        for s in start:
            seen.setdefault(tuple(text[s:s + least]), []).append(s)
        assert {int(s) for s in start if hit[s]} == {int(s) for v in seen.values() if len(v) > 1 for s in v}


@pytest.mark.parametrize("seed", range(3))
def test_matching_statistics(seed):
    rng = np.random.default_rng(seed)
    parts = [rng.integers(1, 5, 50) for _ in range(6)]
    index = sx.FMIndex(parts, 6)
    stream = rng.integers(1, 6, 80)
    length, low, high = index.match(stream, np.arange(1, 81), 8)
    held = [tuple(p[i:i + n]) for p in parts for n in range(1, 9) for i in range(51 - n)]
    for end in range(1, 81):
        best = max((n for n in range(1, min(8, end) + 1) if tuple(stream[end - n:end]) in set(held)), default=0)
        assert length[end - 1] == best
        if best:
            assert high[end - 1] - low[end - 1] == held.count(tuple(stream[end - best:end]))


def test_anchor_runs_cover_each_window_once():
    rng = np.random.default_rng(1)
    symbols, bounds = rng.integers(0, 3, 500), np.array([0, 0, 40, 300, 310, 500])
    from hazeworks.llm.text import Hashed

    place, low, high, _ = rp.anchor_runs(Hashed(symbols), bounds, 20, 5)
    windows = np.concatenate([np.arange(x, y + 1) for x, y in zip(low, high, strict=True)])
    inside = [s for s in range(481) if any(a <= s and s + 20 <= b for a, b in zip(bounds, bounds[1:], strict=False))]
    assert windows.tolist() == inside
    assert ((place >= high) & (place + 5 <= low + 20)).all()


def test_words_of_a_shard_are_words():
    texts = [b"a b  c d", b"b c\td"]
    values = compare_words([np.frombuffer(t, np.uint8) for t in texts], np.array([4, 9]), 3, None, None)
    assert [v.tolist() for v in values] == [[4, 4], [4]]
