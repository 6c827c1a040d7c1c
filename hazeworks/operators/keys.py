"""The identity of a reading, (city, measurement time), in a form free of nulls.

Null parts count as equal. With null-free parts that is plain equality, so the grouping of the
deduplication, the distinct over stored keys and the joins between them all hash the same columns and
share one shuffle per side; a null-safe `<=>` join would hash derived expressions and shuffle again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_PARTS = ["_city", "_no_city", "_time", "_no_time"]


def key_columns(readings: DataFrame):
    time_type = readings.schema["recorded_at"].dataType.simpleString()
    epoch = F.lit("1970-01-01 00:00:00").cast(time_type)
    no_city, no_time = F.col("city").isNull(), F.col("recorded_at").isNull()
    parts = (F.coalesce("city", F.lit("")), no_city, F.coalesce("recorded_at", epoch), no_time)
    return dict(zip(KEY_PARTS, parts))


def has_key(readings: DataFrame) -> bool:
    return set(KEY_PARTS) <= set(readings.columns)


def with_key(readings: DataFrame) -> DataFrame:
    return readings if has_key(readings) else readings.withColumns(key_columns(readings))


def without_key(readings: DataFrame) -> DataFrame:
    return readings.drop(*KEY_PARTS)
