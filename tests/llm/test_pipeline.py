from __future__ import annotations

import hashlib
import sys
from pathlib import Path

import corpus_pipeline as cp
from hazeworks.llm.decontam import decontaminated

sys.path.insert(0, str(Path(__file__).parent))

from test_repeats import brute_bytes  # noqa: E402
from test_search import full_alignments  # noqa: E402
from test_simhash import brute_components, brute_fingerprint  # noqa: E402


def test_stages_keep_columns_and_rows(spark, sf_dir, table):
    docs, counts = table("documents"), []
    columns = docs.columns
    for name, stage in cp.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        counts.append(docs.count())
        if name != "mix":
            assert docs.columns == columns
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
    assert counts[0] > counts[1] > 0 and counts[2] == counts[1] >= counts[3] == counts[4]
    assert sorted(map(str, cp.run(spark, sf_dir).collect())) == sorted(map(str, docs.collect()))


def test_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is cp.run
    assert "op2_source_mixing" in entry.oracle_sql()


def test_near_duplicates_equal_brute_force(spark, sf_dir, table):
    """One document of each component of fingerprints, the one with the smallest id."""
    docs = table("documents")
    rows = docs.collect()
    component = brute_components({r.doc_id: brute_fingerprint(r.text) for r in rows})
    kept = dict(cp.STAGES)["near_duplicates"](spark, docs, sf_dir)
    assert sorted(map(tuple, kept.collect())) == sorted(tuple(r) for r in rows if component[r.doc_id] == r.doc_id)


def test_repeated_text_equals_brute_force(spark, sf_dir, table):
    docs = table("documents").limit(120)
    rows = docs.collect()
    digests = {r[0]: r[4] for r in brute_bytes([(r.doc_id, r.text) for r in rows], 200)}
    cut = dict(cp.STAGES)["repeated_text"](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in cut} == set(digests)
    whole = [r for r in cut if "�" not in r.text and hashlib.sha256(r.text.encode()).hexdigest() == digests[r.doc_id]]
    # Cuts inside a character of several bytes move to its edges, so those texts differ from the byte digest.
    assert len(whole) > 0.8 * len(cut) and all(r.n_chars == len(r.text) for r in cut)


def test_benchmark_equals_alignment_of_all_pairs(spark, sf_dir, table):
    docs, bench = table("documents").limit(60), table("benchmark").limit(60)
    copies = full_alignments([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    kept = decontaminated(docs, bench).collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in docs.collect()} - {d for d, _ in copies}


def test_stages_on_odd_empty_and_clashing_tables(spark, sf_dir, odd, clashing, empty):
    for docs in (odd, clashing, empty):
        for name, stage in cp.STAGES:
            before, docs = docs, stage(spark, docs, sf_dir)
            rows = docs.collect()
            assert len(rows) <= before.count()
            if name != "mix":
                assert docs.columns == before.columns
                docs = spark.createDataFrame(rows, docs.schema)
