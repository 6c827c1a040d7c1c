"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

# The corpus queries have tests of their own.
QUERIES = {k: q for k, q in entry_module.queries().items() if k not in entry_module.corpus_queries()}
ORACLES = {k: q for k, q in entry_module.oracle_sql().items() if k not in entry_module.corpus_sql()}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    result = QUERIES[name](spark, sf_dir)
    rows = result.collect()
    assert rows, "a query over the test data gives rows"
    if name not in ORACLES:
        return
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert rows_of(result.columns, rows) == rows_of(columns, expected.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
