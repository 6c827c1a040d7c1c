"""Pollutant columns to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.operators.latest import latest_per_city
from hazeworks.operators.lookup import with_pollutant_name
from hazeworks.schemas import POLLUTANTS


def pollutant_long(readings: DataFrame) -> DataFrame:
    """One row per reading and measured pollutant, with name and unit. No shuffle."""
    long = readings.unpivot(["city", "fetched_at"], list(POLLUTANTS), "pollutant", "value")
    return with_pollutant_name(long.where(F.col("value").isNotNull()))


def pollutant_profile(readings: DataFrame, city: str) -> DataFrame:
    """The measured pollutants of a city's latest reading."""
    latest = latest_per_city(readings.where(F.col("city") == city))
    return pollutant_long(latest).select(F.col("name").alias("pollutant"), "value", "unit")
