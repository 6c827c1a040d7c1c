"""Row counts of the cleaning step and the gates built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.operators.clean import type_readings
from hazeworks.schemas import KEY_COLUMNS


def key_counts(raw: DataFrame) -> DataFrame:
    """Raw and valid rows per key: the mergeable form of all cleaning counters."""
    return type_readings(raw).groupBy(*KEY_COLUMNS).agg(
        F.count("*").alias("raw_rows"),
        F.count("aqi").alias("valid_rows"),
    )


def quality_counts(raw: DataFrame) -> DataFrame:
    """Rows read, rows with a valid AQI, rows left after deduplication; one shuffle of key counts."""
    return key_counts(raw).agg(
        F.coalesce(F.sum("raw_rows"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum("valid_rows"), F.lit(0)).alias("valid_rows"),
        F.count_if(F.col("valid_rows") > 0).alias("clean_rows"),
    )


class EmptyBatchError(ValueError):
    """A load step has nothing to work on."""


def require_rows(count: int, what: str) -> int:
    if count == 0:
        raise EmptyBatchError(f"no {what}: nothing to load")
    return count
