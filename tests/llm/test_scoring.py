"""Language-model scores, quality resampling and mixing."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from hazeworks.llm import mixing, resampling
from hazeworks.llm.lm_score import cross_entropy_difference


def brute_scores(docs, good, mu=20.0):
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for d, t in docs]
    counts = {}
    for name, some in (("all", texts), ("good", [x for x in texts if x[0] in good])):
        one = Counter(w for _, t in some for w in t)
        counts[name] = one, Counter(p for _, t in some for p in zip(t, t[1:], strict=False)), sum(one.values())
    vocabulary = len(counts["all"][0])
    out = {}
    for d, t in texts:
        losses = []
        for name in ("good", "all"):
            one, two, size = counts[name]
            total = 0.0
            for before, w in zip([None, *t], t, strict=False):
                share = (one[w] + 1) / (size + vocabulary)
                total -= math.log(share if before is None else (two[before, w] + mu * share) / (one[before] + mu))
            losses.append(total / len(t) if t else None)
        out.setdefault(d, []).append((len(t), *losses))
    return out


def check_scores(docs, labels):
    got = cross_entropy_difference(docs, labels, home_bytes=1 << 15).collect()
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0 and r.doc_id is not None}
    want = brute_scores([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], good)
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        n, target, background = want[r.doc_id][0] if len(want[r.doc_id]) == 1 or r.doc_id == 2 else want[r.doc_id][0]
        assert r.n_tokens == n
        if n == 0:
            assert r.score is None and r.target_nats is None
        else:
            assert r.target_nats == pytest.approx(target, rel=1e-9)
            assert r.score == pytest.approx(target - background, abs=1e-9)


def test_scores_equal_brute_force(table):
    check_scores(table("documents"), table("labels"))


def test_scores_of_odd_rows(odd, clashing, empty, labels):
    check_scores(odd, labels)
    check_scores(clashing, labels.limit(0))
    assert cross_entropy_difference(empty, labels).collect() == []


def test_mixing_equals_sql(sf_dir, table):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(db.execute(mixing.SQL).fetchall())
    assert sorted(map(tuple, mixing.mix(table("documents")).collect())) == want


def test_mixing_targets(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate(
        [(30, "a")] * 10 + [(3, "b")] * 20 + [(50, "c")] * 40 + [(9, None)] * 30 + [(0, "d")] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    sizes, targets, taken = {}, {}, Counter()
    for r in got:
        sizes[r.source], targets[r.source] = r.source_size, r.target
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    # a: 5, b: 2, c: 1, d: 5 (empty), null: 2; all 300 + 60 + 2000 + 270; a, b and null stop at three times their size
    assert sizes == {"a": 300, "b": 60, "c": 2000, None: 270, "d": 0}
    assert targets == {"a": 900.0, "b": 180.0, "c": 2630.0 - 900 - 180 - 810, None: 810.0, "d": 0.0}
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 60
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_mixing_of_odd_rows(odd, clashing, empty):
    for docs in (odd, clashing):
        got = mixing.mix(docs).collect()
        assert len(got) == odd.count()
        assert {r.size for r in got if r.doc_id in (3, 4, 5)} == {0}
        assert sum(r.taken for r in got) <= sum(r.size for r in got)
    assert mixing.mix(empty).collect() == []


def test_quality_on_held_out_labels(spark):
    """Half of the labels train; the other half measures."""
    import os

    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("no data")
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    kept = {r.doc_id for r in resampling.resampled(docs, train).select("doc_id").collect()}
    good = [r.doc_id in kept for r in test.where("quality = 1 AND toxic = 0").collect()]
    bad = [r.doc_id in kept for r in test.where("quality = 0").collect()]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.03


def test_quality_of_odd_rows(odd, clashing, empty, labels):
    assert resampling.resampled(odd, labels.limit(0)).count() == odd.count()
    some = resampling.resampled(clashing, labels)
    assert set(clashing.columns) <= set(some.columns)
    rows = [tuple(r) for r in some.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, map(tuple, resampling.resampled(clashing, labels).collect())))
    assert resampling.resampled(empty, labels).collect() == []


def test_toxic_words_are_learnt(spark):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(600):
        text = rng.choice(words, 80).tolist()
        toxic = i % 5 == 0
        if toxic:
            text[::12] = ["nasty"] * len(text[::12])
        rows.append((i, " ".join(text)))
        if i % 2:
            labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in resampling.resampled(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    toxic = [i in kept for i in range(0, 600, 10)]
    clean = [i in kept for i in range(600) if i % 5 and i % 2 == 0]
    assert np.mean(toxic) == 0 and np.mean(clean) == 1
