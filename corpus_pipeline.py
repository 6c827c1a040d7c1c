"""Corpus pipeline: from all documents to a training mix, in five stages.

1. quality: documents that importance resampling rejects go.
2. near_duplicates: of the documents that SimHash links (four-word shingles, four bits at most), the one with the
   smallest id stays.
3. repeated_text: strings of 200 bytes or more that occur again anywhere are cut out of all texts; documents stay.
4. benchmark: documents that hold a copy of a benchmark item go.
5. mix: what the mix to target weights takes, in the order in which it takes it.

All stages but the last return the columns of their input. Nulls, empty tables, repeated rows and further columns are
treated as the operators say; repeated rows of one document are copies, of which the second stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeworks.llm.decontam import decontaminated
from hazeworks.llm.mixing import mix
from hazeworks.llm.resampling import resampled
from hazeworks.llm.saving import let_workers_import, saved
from hazeworks.llm.simhash import one_of_each
from hazeworks.llm.suffix_dedup import without_repeated_bytes


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return resampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return one_of_each(docs, radius=4, shingle=4)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    cut = without_repeated_bytes(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if (
        "n_chars" in docs.columns) else cut


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_text", repeated_text),
    ("benchmark", benchmark),
    ("mix", mixed),
]

#: SQL cannot express the stages before the mix; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
