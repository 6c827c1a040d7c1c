"""Raw readings to clean readings: typed, banded, valid, one per (city, measurement time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeworks.functions import category_of, to_float, to_instant, to_int
from hazeworks.operators.dedup import dedup_readings
from hazeworks.operators.keys import KEY_PARTS
from hazeworks.schemas import CLEAN_COLUMNS, POLLUTANTS


def clean_city(city: Column) -> Column:
    return F.lower(F.trim(city))


def clean_station(station: Column) -> Column:
    return F.trim(station)


def type_readings(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Normalise, parse and band every raw row; what cannot be parsed becomes null."""
    aqi = to_int(F.col("aqi"))
    return raw.select(
        clean_city(F.col("city")).alias("city"),
        clean_station(F.col("station")).alias("station"),
        aqi.alias("aqi"),
        *[to_float(F.col(p)).alias(p) for p in POLLUTANTS],
        category_of(aqi).alias("aqi_category"),
        F.col("dominant_pollutant"),
        to_instant("recorded_at", raw.schema["recorded_at"].dataType).alias("recorded_at"),
        *carry,
    )


def valid_readings(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("aqi").isNotNull())


def clean(
    raw: DataFrame, *, carry: Sequence[str] = (), tie_breaker: Sequence[str] = (), keep_key: bool = False,
) -> DataFrame:
    """The whole cleaning step. `carry` keeps extra columns of the source in the result."""
    extra = list(dict.fromkeys([*carry, *tie_breaker]))
    valid = valid_readings(type_readings(raw, extra))
    unique = dedup_readings(valid, tie_breaker, keep_key=keep_key)
    return unique.select(*CLEAN_COLUMNS, *carry, *(KEY_PARTS if keep_key else ()))
