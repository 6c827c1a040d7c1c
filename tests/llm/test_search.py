"""Neighbours, archives, licenses and decontamination."""

from __future__ import annotations

import hashlib
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
import regex
from pyspark.sql import functions as F

from hazeworks.llm import ann, decontam, licenses, warc
from hazeworks.llm.saving import shared_folder


def brute_nearest(rows, k=10):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and i is not None and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float) != 0)]
    return {q: sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in good if j != q)[:k]
            for q, v in good if q % 100 == 0}


def test_neighbours_recall(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute_nearest([(r.vec_id, r.embedding) for r in docs.collect()])
    got = {}
    for r in ann.nearest(docs, F.col("vec_id") % 100 == 0, shard_rows=64, block_mb=1).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hit / (10 * len(want)) >= 0.9
    for q in got:
        assert got[q] == sorted(got[q])
        exact = dict((i, s) for s, i in brute_nearest([(r.vec_id, r.embedding) for r in docs.collect()], 10**6)[q]) if q == 0 else {}
        assert all(s == pytest.approx(exact.get(i, s), rel=1e-12) for s, i in got[q])


def test_neighbours_are_verified_one_by_one():
    """The stopping test holds before all vectors are verified: about two thirds of vectors without structure, few of
    clustered ones."""
    rng = np.random.default_rng(2)
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    given = np.array(table["embedding"].to_pylist(), float)
    centres = rng.standard_normal((40, 64)) * 10
    clustered = centres[rng.integers(0, 40, 2000)] + rng.standard_normal((2000, 64))
    for points, most in ((given[np.isfinite(given).all(1) & (given != 0).any(1)], 0.72), (clustered, 0.1)):
        base = np.random.default_rng(11).standard_normal((points.shape[1], 12))
        tree, ids, verified, hits = ann.Tree(points @ base), np.arange(len(points)), 0, 0
        orders = tree.by_distance

        def counted(query, some, orders=orders):
            nonlocal verified
            far = -1.0
            for rows, left in orders(query, some):
                assert left >= far and np.isclose(((tree.points[rows] - query) ** 2).sum(1).min(), left)
                yield rows, left
                far, verified = left, verified + len(rows)

        tree.by_distance = counted
        for q in range(0, len(points), 100):
            _, names = ann.search(tree, points, ids, points[q], points[q] @ base, q, 10, 6, 0.9)
            far = ((points - points[q]) ** 2).sum(1)
            far[q] = np.inf
            hits += len(set(names.tolist()) & set(np.argsort(far, kind="stable")[:10].tolist()))
        queries = len(range(0, len(points), 100))
        assert hits >= 0.95 * 10 * queries
        assert verified <= most * len(points) * queries


def test_neighbours_in_blocks_of_queries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    many = docs.crossJoin(spark.range(3).withColumnRenamed("id", "copy")).withColumn(
        "vec_id", F.col("vec_id") + F.col("copy") * 1000).drop("copy")
    asks = F.col("vec_id") % 2 == 0
    one = ann.nearest(many, asks, block_mb=64).collect()
    assert sorted(one) == sorted(ann.nearest(many, asks, block_mb=0.05).collect())


def test_neighbours_of_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [nan, 1.0]), (400, [1.0, None]), (500, [float("inf"), 1.0]),
            (600, [1.0]), (None, [1.0, 1.0])] + [(i, [2.0, 0.0]) for i in range(1, 40)] + [(700, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"v": F.lit(1), "rank": F.lit(2)})
    got = ann.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert by[0] == [(i, i, 1.0) for i in range(1, 11)]
    assert by[700] == [(i, i, 0.0) for i in range(1, 11)]
    assert set(by) == {0, 700}
    assert ann.nearest(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    few = ann.nearest(df.where("vec_id IN (0, 3)"), F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r.vec_id) for r in few] == [(0, 3)]


@pytest.mark.parametrize("half, x, p", [(1, 2.0, 0.6321205588), (4, 15.507, 0.95), (4, 0.0, 0.0)])
def test_chi_square(half, x, p):
    assert ann.chi_square_below(x, half) == pytest.approx(p, abs=1e-5)


def brute_archive(rows, least=100):
    first = {}
    for p, _, h in rows:
        h = h or ""
        if p is not None and len(h.encode()) >= least:
            first[h] = min(first.get(h, p), p)
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        to = first.get(h or "")
        later = p is not None and to is not None and p > to
        out.append((p, len(data), hashlib.sha256(data).hexdigest(), "revisit" if later else "response", to if later else None))
    return sorted(out, key=str)


def archive(pages):
    rows = warc.archived(pages, shared_folder(pages.sparkSession, "warc"))
    return rows.collect()


def test_archive_equals_brute_force(table):
    pages = table("pages")
    got = archive(pages)
    want = brute_archive([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want
    assert [(r.url_key, r.captured) for r in got] == sorted((r.url_key, r.captured) for r in got)
    assert {(r.page_id, r.url) for r in got} == {(r.page_id, r.url) for r in pages.collect()}


def test_archive_of_odd_rows(spark):
    page = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 9
    rows = [(5, "http://b.org/x%0A?q=1", page), (3, "http://a.org/\r\nX: y", page), (9, None, page), (9, None, page),
            (1, "", None), (2, "not a url [", ""), (4, "http://a.org/", "short"), (6, "http://a.org/", "short"),
            (None, "http://c.org", page), (7, "http://d.org", "漢" * 100_000), (8, "http://d.org", "a\r\n\r\nWARC/1.1"),
            (10, "http://d.org", "\r\n\r\nWARC/1.1\r\n" * 3), (11, "http://d.org", "\r\n\r\n"), (12, "http://d.org", "\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("mine"))
    got = archive(pages)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == (
        brute_archive(rows))
    assert {(r.page_id, r.url) for r in got} == {(p, u or "") for p, u, _ in rows}
    assert archive(pages.limit(0)) == []


@pytest.mark.parametrize("runs_of, ranges, block, each", [(7, 5, 3, 4), (1, 3, 1, 32), (50, 1, 2, 1), (1000, 40, 64, 2)])
def test_merge_of_many_small_runs(spark, runs_of, ranges, block, each):
    rows = [(i if i % 9 else None, f"http://h{i % 3}.org/{'x' * (i % 4) * 200}" if i % 5 else "http://hot.org/", f"page {i % 40}" * 20)
            for i in range(600)]
    folder = shared_folder(spark, "warc")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), folder + "/a", records_per_archive=90)
    warc.read_runs(spark, folder + "/a", most=runs_of).write.parquet(folder + "/r")
    runs = spark.read.parquet(folder + "/r")
    assert runs.groupBy("archive", "run").count().agg(F.max("count")).first()[0] <= runs_of
    got = [tuple(r) for r in warc.merged(runs, ranges, block, each).collect()]
    assert got == sorted((tuple(r)[:10] for r in runs.collect()), key=warc.order)
    assert len(got) == 600


def test_blocks_arrive_as_the_merge_needs_them(spark):
    # One run has keys far apart, the other all of its keys between two of them: blocks are used up at different speeds.
    rows = [(i, "u", f"k{i:05d}", "t", i, "d", "response", None, "a", i, 0, n) for n, i in enumerate(range(0, 4000, 400))]
    rows += [(i, "u", f"k{i:05d}", "t", i, "d", "response", None, "b", i, 0, n) for n, i in enumerate(range(401, 799))]
    runs = spark.createDataFrame(rows, warc.RUNS).coalesce(1)
    got = [r.page_id for r in warc.merged(runs, 1, 2).collect()]
    assert got == sorted(r[0] for r in rows)


def test_archive_that_is_cut_off(spark):
    whole = (b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello", b"Content-Length: 3\r\n\r\nyou\r\n\r\n")
    got = list(warc.parse([("a", whole[0]), ("a", whole[1])]))
    assert [(r[0], r[1], r[3]) for r in got] == [("a", 0, b"hello"), ("a", 40, b"you")]
    for pieces in ([("a", whole[0][:-1])], [("a", whole[0][:-1]), ("b", whole[0])], [("a", whole[0] + b"x")], [("a", b"x")]):
        with pytest.raises(ValueError):
            list(warc.parse(pieces))


@pytest.mark.parametrize("count", [0, 1, 2, 3, 7, 8])
def test_loser_tree(count):
    rng = np.random.default_rng(count)
    rows = [("p", "u", f"k{rng.integers(9)}", f"t{rng.integers(9)}", int(i), i, "a", i, "f", int(i)) for i in rng.permutation(60)]
    rows = [(r[4], *r[1:]) for r in rows]
    runs = [sorted(rows[i::count], key=warc.order) for i in range(count)]
    assert list(warc.LoserTree(runs)) == (sorted(rows, key=warc.order) if count else [])


def brute_base(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def test_licenses_equal_brute_force(table, odd):
    for docs in (table("documents"), odd):
        want = sorted(((r.doc_id, *brute_base(r.text)) for r in docs.select("doc_id", "text").collect()), key=str)
        got = licenses.scan(docs).collect()
        assert sorted((tuple(r)[:6] for r in got), key=str) == want
        for r in got:
            assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
            assert 0 <= r.score <= 1


@pytest.mark.parametrize("text, label, errors", [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit", 0),
    ("Permision is herby granted free of charge to any person obtaning a copy", "mit", 3),
    ("x Licensed under the Apache Licence, Version 2.0 y", "apache-2.0", 1),
    ("LICENSED UNDER CC BY-NC 4.0.", "cc-by-nc", 0),
    ("redistribution und use in source and binary forms", "bsd", 1),
])
def test_notices_with_errors(text, label, errors):
    row = licenses.scan_text(text.encode(), tuple(licenses.NOTICES.items()))
    assert label in row[5].split(",")
    assert min(s["errors"] for s in row[7] if s["label"] == label) == errors


def recursive_places(line, notice, low, high):
    """The best place of all, then the same before and behind it."""
    e = licenses.errors_of(notice)
    m = regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={e}}}").search(line, low, high)
    return [] if m is None else [*recursive_places(line, notice, low, m.start()), (m.start(), m.end(), sum(m.fuzzy_counts)),
                                 *recursive_places(line, notice, m.end(), high)]


def test_notices_next_to_each_other():
    bad, good = "released under the mit licence", "released under the mit license"
    for text, errors in ((f"{bad} {good}", [1, 0]), (f"{good} {bad}", [0, 1]), (f"{bad} {bad} {good} {bad}", [1, 1, 0, 1])):
        spans = [s for s in licenses.scan_text(text.encode(), tuple(licenses.NOTICES.items()))[7] if s["label"] == "mit"]
        assert [(s["first_word"], s["last_word"], s["errors"]) for s in spans] == [
            (5 * i, 5 * i + 4, e) for i, e in enumerate(errors)]


@pytest.mark.parametrize("seed", range(3))
def test_notices_equal_search_of_whole_text(seed):
    rng = np.random.default_rng(seed)
    notices = tuple(licenses.NOTICES.items())
    for _ in range(30):
        notice = notices[int(rng.integers(len(notices)))][0]
        copies = []
        for _ in range(6):
            letters = list(notice)
            for at in rng.choice(len(letters) - 1, int(rng.integers(0, licenses.errors_of(notice) + 1)), replace=False):
                letters[at] = ["", "q", letters[at] + "q"][int(rng.integers(3))]
            copies.append("".join(letters) + ["", " ", " license "][int(rng.integers(3))])
        line = " " + "".join(copies) + " "
        got = [m[1:] for m in licenses.fuzzy(line, ((notice, "x"),))]
        assert got == recursive_places(line, notice, 0, len(line))


def test_long_texts_full_of_places():
    notices, start = tuple(licenses.NOTICES.items()), time.process_time()
    row = licenses.scan_text(b"cc by the " * 1_000_000, notices)
    assert row[:4] == (3_000_000, 1_000_000, 0, 2_999_997)
    row = licenses.scan_text(b"released under the mit licence " * 30_000, notices)
    assert [(s["first_word"], s["last_word"], s["errors"]) for s in row[7]] == [(5 * i, 5 * i + 4, 1) for i in range(30_000)]
    assert time.process_time() - start < 60


def test_no_notice():
    assert licenses.scan_text(b"an apache helicopter, licensed to fly under the radar", tuple(licenses.NOTICES.items()))[5] == ""
    assert licenses.scan_text("the mit licensee; mit-license".encode(), ())[1:6] == (1, 3, 3, "mit", "mit")


def test_licenses_of_odd_rows(clashing, empty, odd):
    assert licenses.scan(clashing).count() == odd.count()
    assert licenses.scan(empty).collect() == []


def edits(words, rng, share):
    return [f"new{rng.integers(1000)}" if rng.random() < share else w for w in words]


def test_decontamination(spark):
    rng = np.random.default_rng(5)
    word = lambda: f"v{int(rng.zipf(1.3)) % 5000}"
    items = [[word() for _ in range(int(rng.integers(15, 60)))] for _ in range(30)]
    rows, leaks = [], set()
    for i in range(400):
        text = [word() for _ in range(200)]
        if i % 4 == 0:
            k = int(rng.integers(30))
            own = items[k] if i % 8 else edits(items[k], rng, 0.12)
            text[50:50] = own
            leaks.add((i, k))
        rows.append((i, " ".join(text).title() + "."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    for block in (10**6, 200):
        got = decontam.contaminated(docs, bench, block_words=block).collect()
        assert {(r.doc_id, r.item_id) for r in got} == leaks
        assert all(40 <= r.first_word <= 60 and r.last_word < 120 for r in got)
    kept = {r.doc_id for r in decontam.decontaminated(docs, bench).collect()}
    assert kept == {i for i in range(400) if i % 4}


@pytest.mark.parametrize("every, size", [(4, 15), (4, 20), (5, 15), (5, 20), (5, 59)])
def test_items_with_regular_edits(spark, every, size):
    """Every 4th or 5th word replaced: each copy is found, whatever is rare in it."""
    rng = np.random.default_rng(every * size)
    items = [[f"v{w}" for w in rng.integers(0, 3000, size)] for _ in range(100)]
    copies = [[f"new{i}" if i % every == every - 1 else w for i, w in enumerate(item)] for item in items]
    fill = [f"f{i}" for i in range(30)]
    docs = spark.createDataFrame([(k, " ".join([*fill, *c, *fill])) for k, c in enumerate(copies)], "doc_id long, text string")
    # each n-gram as often as chance has it, so that the rarest ones lie anywhere
    noise = spark.createDataFrame([(1000 + i, " ".join(items[i % 100][j:j + 3])) for i, j in enumerate(
        rng.integers(0, size - 2, 2000).tolist())], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = decontam.contaminated(docs.unionByName(noise), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.doc_id < 1000} == {(k, k) for k in range(100)}
    assert {r.doc_id for r in decontam.decontaminated(docs, bench).collect()} == set()


def test_excerpts_of_items(spark):
    """Thirteen words in a row of an item are a copy, however long the item is; twelve are not."""
    item = [f"w{i}" for i in range(59)]
    fill = [f"f{i}" for i in range(40)]
    rows = [(k, " ".join([*fill, *item[start:start + n], *fill]))
            for k, (start, n) in enumerate([(20, 20), (0, 13), (46, 13), (20, 12), (0, 0)])]
    rows.append((5, " ".join([*item[:12], *fill, *item[30:42]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.score, r.first_word, r.last_word) for r in decontam.contaminated(docs, bench).collect()}
    assert got == {0: (20 / 59, 40, 59), 1: (13 / 59, 40, 52), 2: (13 / 59, 40, 52)}
    assert {r.doc_id for r in decontam.decontaminated(docs, bench).collect()} == {3, 4, 5}


def test_words_put_into_an_item(spark):
    """As many further words inside a copy as its score allows."""
    item = [f"w{i}" for i in range(20)]
    more = [f"n{i}" for i in range(23)]
    docs = spark.createDataFrame([(1, " ".join([*item[:11], *more[:9], *item[11:16], *more[9:], *item[16:]]))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = decontam.contaminated(docs, bench).collect()
    assert [(r.score, r.first_word) for r in got] == [(23 / 40, 0)]


@pytest.mark.parametrize("seed", range(4))
def test_alignment_equals_dynamic_programming(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(2, 6, 12).astype(np.uint64), rng.integers(2, 6, 20).astype(np.uint64)
    table = np.zeros((13, 21), int)
    for i in range(1, 13):
        for j in range(1, 21):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
    best, end_a, end_b = decontam.local_scores(a[None], b[None])
    assert best[0] == table.max() == table[end_a[0], end_b[0]]


def test_decontamination_of_odd_rows(odd, clashing, empty, spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "two words"), (4, " ".join(odd.first().text.split()[:30]))],
                                  "item_id long, text string")
    hits = decontam.contaminated(clashing, bench).collect()
    assert {r.doc_id for r in hits if r.doc_id is not None} >= {1, 2} and {r.item_id for r in hits} == {4}
    assert len([r for r in hits if r.doc_id == 2]) == 2
    assert decontam.decontaminated(clashing, bench).columns == clashing.columns
    assert decontam.contaminated(empty, bench).collect() == []
    assert decontam.contaminated(odd, bench.limit(0)).collect() == []
    assert decontam.decontaminated(odd, bench.limit(0)).count() == odd.count()


def full_alignments(docs, bench, least=0.4, n=3, verbatim=13):
    """Every document against every item, whole texts."""
    def values(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return decontam.word_values(data, np.array([0, len(data)]))[0]

    want = {}
    for doc_id, text in docs:
        words = values(text)
        for item_id, item in bench:
            own = values(item)
            if len(own) < n or len(words) < n:
                continue
            grams = set(decontam.gram_values(words, n).tolist())
            if not grams & set(decontam.gram_values(own, n).tolist()):
                continue
            score = int(decontam.local_scores(own[None], words[None])[0][0]) / (2 * len(own))
            copied = len(own) >= verbatim and len(words) >= verbatim and bool(
                set(decontam.gram_values(words, verbatim).tolist()) & set(decontam.gram_values(own, verbatim).tolist()))
            if score >= least or copied:
                want[doc_id, item_id] = score
    return want


@pytest.mark.parametrize("hits", [1 << 17, 7])
def test_contaminated_equals_alignment_of_all_pairs(spark, monkeypatch, hits):
    """Also where the places of common seeds are looked at a few at a time."""
    monkeypatch.setattr(decontam, "_HITS", hits)
    rng = np.random.default_rng(8)
    word = lambda: f"v{int(rng.zipf(1.4)) % 300}"
    prompt = [word() for _ in range(5)]  # begins every item and stands in most documents
    items = [prompt + [word() for _ in range(int(rng.integers(5, 40)))] for _ in range(25)] + [["one", "two"], []]
    rows = []
    for i in range(60):
        text = [word() for _ in range(int(rng.integers(0, 150)))]
        if i % 3:
            text[len(text) // 2:len(text) // 2] = edits(items[i % 25], rng, 0.1 * (i % 5))
        if i % 4 == 0:
            text += prompt * 3
        rows.append((i, " ".join(text)))
    bench = [(i, " ".join(w)) for i, w in enumerate(items)]
    want = full_alignments(rows, bench)
    data, offsets = decontam.tx.utf8(decontam.pa.array([t for _, t in rows]))
    words, bounds = decontam.word_values(data, offsets)
    own = decontam.items_of(decontam.pa.table({"item_id": [i for i, _ in bench], "text": [t for _, t in bench]}), 3)
    got = {(d, i): s for d, i, s, _, _ in decontam.align(own, words, bounds, 0.4, 13)}
    assert got == pytest.approx(want) and len(got) > 25
    assert {d for d, *_ in decontam.align(own, words, bounds, 0.4, 13, any_=True)} == {d for d, _ in want}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench_df = spark.createDataFrame(bench, "item_id long, text string")
    found = decontam.contaminated(docs, bench_df).collect()
    assert {(r.doc_id, r.item_id): r.score for r in found} == pytest.approx(want)
    assert {r.doc_id for r in decontam.decontaminated(docs, bench_df).collect()} == set(range(60)) - {d for d, _ in want}


@pytest.mark.parametrize("seed", range(3))
def test_scores_without_places(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 6, (20, 15)), rng.integers(0, 6, (20, 30))
    assert decontam.best_scores(a, b).tolist() == decontam.local_scores(a, b)[0].tolist()
