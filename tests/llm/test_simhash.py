from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from hazeworks.llm import simhash as sh
from hazeworks.llm.components import components


def brute_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=4):
    ids = sorted(fps, key=str)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                root[a] = b
    groups = {}
    for i in ids:
        groups.setdefault(top(i), []).append(i)
    return {i: min(g) for g in groups.values() for i in g}


def test_equals_brute_force(table):
    docs = table("documents")
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    want = brute_components(fps)
    got = sh.near_duplicates(docs).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (d, f"{f:016x}", want[d]) for d, f in fps.items()}


def test_close_fingerprints_in_large_buckets(spark):
    """Thousands of fingerprints around a few centres, with buckets dealt again and again."""
    rng = np.random.default_rng(3)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 4, dtype=np.uint64).tolist():
        for _ in range(150):
            fps.add(centre ^ sum(1 << int(b) for b in rng.choice(12, 3, replace=False)))
    for _ in range(100):
        fps.add(int(rng.integers(0, 1 << 63)))
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    want = brute_components({f: f for f in fps})
    for most in (1000, 3):
        roots = {r.node: r.root for r in components(sh.linked(df, 4, most)).collect()}
        as_int = {f: int(np.uint64(f).view(np.int64)) for f in fps}
        groups = lambda g: {frozenset(k for k in fps if g(k) == r) for r in {g(k) for k in fps}}
        assert groups(lambda f: roots.get(as_int[f], as_int[f])) == groups(lambda f: want[f])


@pytest.mark.parametrize("level", range(3))
def test_masks_cover_every_pattern_within_the_radius(level):
    masks = [m & (1 << 64) - 1 for m in sh.masks(4, level)]
    assert len(masks) == 31
    rng = np.random.default_rng(0)
    for _ in range(3000):
        pattern = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(pattern & m == 0 for m in masks)
    assert all(20 <= m.bit_count() <= 44 for m in masks)


def test_odd_rows(odd, clashing, empty):
    rows = odd.collect()
    for docs in (odd, clashing):
        got = sh.near_duplicates(docs).collect()
        assert len(got) == len(rows)
        by = {r.doc_id: r for r in got}
        assert by[2].component_id == 1 == by[9].component_id or by[9].fingerprint != by[1].fingerprint
        assert by[3].fingerprint == by[4].fingerprint == by[5].fingerprint == "0" * 16
        assert by[3].component_id == by[5].component_id == 3
        assert by[None].component_id is None or by[None].component_id > 0
    assert sh.near_duplicates(empty).collect() == []
    kept = sh.one_of_each(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)[:3] == [1, 3, 6]
    assert sh.one_of_each(empty).collect() == []


def test_rows_that_share_an_id(spark):
    """Different texts under one id are different documents; one row stays of each component."""
    texts = [" ".join(f"{c}{i}" for i in range(80)) for c in "abc"]
    near = texts[1] + " tail"
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[1]), (5, near), (5, texts[2]), (6, texts[0]), (7, near), (None, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sh.one_of_each(docs).collect()
    assert sorted(r.text[0] for r in got if r.doc_id == 5) == ["a", "b", "c"]
    assert {r.doc_id for r in got} == {5, None} and len(got) == 4


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {roots[i] for i in range(100, 141)} == {100} and {roots[i] for i in range(500, 560)} == {500}
    assert roots[7] == 7
