"""Stored readings in a relational database, through Spark's JDBC source.

The driver jar comes from the caller (`spark.jars`).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from hazeworks.schemas import READING_COLUMNS


def connection_options(host: str, port: int, database: str, user: str, password: str, *, kind: str = "mysql",
                       **more: str) -> dict[str, str]:
    """Options of Spark's JDBC source. The host has to be reachable from every executor; it is used as given."""
    return {"url": f"jdbc:{kind}://{host}:{port}/{database}", "user": user, "password": password, **more}


def read_fact_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    *,
    lower: str,
    upper: str,
    partitions: int,
    partition_column: str = "recorded_at",
) -> DataFrame:
    """The twelve reading columns. Ranges of `partition_column` are read in parallel.

    Measurement times spread the rows of one load; all of its rows share one ingestion time.
    Spark pushes the column list and simple filters into the query. Bounds only place the ranges;
    rows outside of them (and nulls) are read by the first and the last range.
    """
    reader = spark.read.format("jdbc").options(**options).options(
        dbtable=table, partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, fetchsize=10_000,
    )
    return reader.load().select(*READING_COLUMNS)
