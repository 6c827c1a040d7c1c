"""Latest reading per city and what is read off it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeworks.functions import shout
from hazeworks.operators.topk import first_rows
from hazeworks.schemas import CATEGORY_ROWS, DEFAULT_COLOR

_RECENCY = ("fetched_at", "recorded_at", "station", "aqi")


def latest_per(readings: DataFrame, *keys: str) -> DataFrame:
    """The row with the greatest ingestion time of every group; a missing time counts as latest.

    Written as a maximum over structs: each map task sorts its own rows by key (the state is not of
    fixed width), reduces them to one row per group and sends only those. Ties go to the later
    measurement, then to the greater remaining columns. The maximum of maxima is the maximum, so
    groups may be reduced in steps, from finer keys to coarser ones.
    """
    order = [c for c in _RECENCY if c not in keys]
    payload = [c for c in readings.columns if c not in (*keys, *order)]
    newest = F.max(F.struct(F.col("fetched_at").isNull().alias("_undated"), *order, *payload))
    return (
        readings.groupBy(*keys).agg(newest.alias("_newest"))
        .select(*[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in readings.columns])
    )


def latest_per_city(readings: DataFrame) -> DataFrame:
    return latest_per(readings, "city")


def _worst_first() -> list[Column | str]:
    return [F.col("aqi").desc_nulls_last(), "city"]


def by_aqi(latest: DataFrame, worst_first: bool = True) -> DataFrame:
    """Worst city first, missing AQI last; or the other way round, as bars grow, missing AQI first."""
    return latest.orderBy(*(_worst_first() if worst_first else [F.col("aqi").asc_nulls_first(), "city"]))


def category_color(category: Column) -> Column:
    colors = F.create_map(*[F.lit(v) for name, _, _, color in CATEGORY_ROWS for v in (name, color)])
    return F.coalesce(F.try_element_at(colors, category), F.lit(DEFAULT_COLOR))


def worst(latest: DataFrame) -> DataFrame:
    return first_rows(latest, _worst_first(), 1)


def status_panel(latest: DataFrame) -> DataFrame:
    """Status line of the city with the highest current AQI."""
    return worst(latest).select(
        "city",
        shout(F.col("aqi_category")).alias("status"),
        category_color(F.col("aqi_category")).alias("color"),
        F.col("aqi").cast("int").alias("current_aqi"),
        shout(F.col("dominant_pollutant")).alias("primary_pollutant"),
    )


def peak_city(latest: DataFrame) -> DataFrame:
    return worst(latest).select("city", F.col("aqi").cast("int").alias("peak_aqi"))


def delta_to_threshold(latest: DataFrame, threshold: float = 100) -> DataFrame:
    """How far every city's current AQI is above (or below) a reference value."""
    current = F.col("aqi").cast("int")
    return latest.select(
        "city", current.alias("current_aqi"), (current - F.lit(threshold)).alias("delta"))
