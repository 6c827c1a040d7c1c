"""The operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeworks.llm import collocations as phrases
from hazeworks.llm import mixing, spelling
from hazeworks.llm.ann import nearest
from hazeworks.llm.decontam import contaminated
from hazeworks.llm.fm_substring import repeated_words
from hazeworks.llm.licenses import scan
from hazeworks.llm.lm_score import cross_entropy_difference
from hazeworks.llm.prefix_hashes import fingerprints
from hazeworks.llm.resampling import resampled
from hazeworks.llm.saving import let_workers_import, shared_folder
from hazeworks.llm.simhash import near_duplicates
from hazeworks.llm.suffix_dedup import repeated_bytes
from hazeworks.llm.warc import archived


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(table(spark, sf_dir, "documents"), window=13)


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"), min_bytes=200)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = archived(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"), least=100)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "url_key",
                           "captured")


def op7_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return kept.select("doc_id", F.col("__ngrams").alias("n_ngrams"), F.col("__log_weight").alias("log_weight"),
                       F.col("__key").alias("gumbel_key"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), radius=4, shingle=4)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, longest=4, first=2000, share=80)


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), shortest=7, least=2, every=31, times=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_lm_scoring,
        op2_source_mixing,
        op3_fm_substring_dedup,
        op4_nearest_neighbours,
        op5_suffix_array_dedup,
        op6_warc,
        op7_quality_resampling,
        op8_simhash_near_dedup,
        op9_license_scan,
        op10_benchmark_decontamination,
        op11_phrase_collocations,
        op12_document_fingerprints,
        op13_spelling_variants,
    )}


def oracle_sql() -> dict[str, str]:
    """DuckDB twins. The other queries are tested against brute force instead."""
    return {"op2_source_mixing": mixing.SQL, "op11_phrase_collocations": phrases.SQL, "op13_spelling_variants": spelling.SQL}
