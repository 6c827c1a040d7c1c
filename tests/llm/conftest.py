from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("source", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                       T.StructField("toxic", T.IntegerType())])
#: Names that operators use inside, as columns of the caller.
CLASHES = ["home", "key", "fp", "size", "finish", "rank", "score", "section", "record", "a", "b", "root", "node"]


def odd_rows() -> list[tuple]:
    """Null and empty texts, ties, repeated rows, a very long text, characters of several bytes, a null id."""
    prose = " ".join(f"word{i % 97}{'é' if i % 7 else 'ß漢'}" for i in range(60))
    long = " ".join(f"w{i * i % 1009}" for i in range(60_000))
    rows = [(1, prose, "a"), (2, prose, "b"), (2, prose, "b"), (3, None, "a"), (4, "", None), (5, " \t\r\n", "c"),
            (6, "x", "a"), (7, long, "a"), (8, long[:3000] + " other end", "b"), (9, prose.upper(), "é"),
            (10, "漢" * 300, "b"), (11, "漢" * 301, None), (None, prose + " tail", "a"), (12, "The MIT License", "z")]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark, odd):
    from pyspark.sql import functions as F
    return odd.withColumns({c: F.lit("mine") for c in CLASHES})


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (7, 1, 0), (9, None, 0), (None, 1, 0), (6, 0, 0)], LABELS)


@pytest.fixture(scope="session")
def table(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
