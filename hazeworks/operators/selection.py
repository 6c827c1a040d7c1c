"""Distinct values and the multi-select filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.operators.prepare import city_name
from hazeworks.operators.topk import first_rows
from hazeworks.schemas import UNKNOWN

#: Up to so many names are conditions that the file scan can use; more are joined.
LONG_LIST = 200


def _distinct(readings: DataFrame, column: str) -> DataFrame:
    # Partial aggregation leaves one row per value and task.
    return readings.select(column).where(F.col(column).isNotNull()).distinct()


def distinct_values(readings: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, nulls dropped."""
    return _distinct(readings, column).orderBy(column)


def first_values(readings: DataFrame, column: str, count: int = 3) -> DataFrame:
    """The first `count` distinct values in sort order: the selection a monitor starts with."""
    return first_rows(_distinct(readings, column), [column], count)


def filter_selection(
    readings: DataFrame,
    cities: Sequence[str] | DataFrame | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the chosen cities and categories; None means no restriction."""
    if cities is not None and not isinstance(cities, DataFrame) and len(cities) > LONG_LIST:
        cities = readings.sparkSession.createDataFrame([(c,) for c in cities], "city string")
    if isinstance(cities, DataFrame):
        readings = readings.join(cities.select("city").distinct(), "city", "left_semi")
    elif cities is not None:
        readings = readings.where(F.col("city").isin(list(cities)))
    if categories is not None:
        readings = readings.where(F.col("aqi_category").isin(list(categories)))
    return readings


def stored_spellings(fact: DataFrame, cities: Sequence[str]) -> list[str | None]:
    """The stored city names that are shown as one of `cities`, of LONG_LIST at most. One small job over one column."""
    if "stored" in fact.columns:
        spelled = fact.where(F.col("city").isin(list(cities))).select(F.col("stored").alias("city")).distinct()
    else:
        spelled = fact.select("city").distinct().where(city_name(F.col("city")).isin(list(cities)))
    return [row["city"] for row in spelled.collect()]


def spelled_as(fact: DataFrame, chosen: DataFrame) -> DataFrame:
    """(stored): the stored names that are shown as one of the names in `chosen` (`city`)."""
    spelled = fact.select("stored", "city") if "stored" in fact.columns else fact.select(
        F.col("city").alias("stored")).distinct().withColumn("city", city_name(F.col("stored")))
    return spelled.join(chosen.select("city").distinct(), "city", "left_semi").select("stored").distinct()


def semi_filtered(fact: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose stored city is among `stored`, null included. Spark broadcasts the names below its threshold, and else
    may filter by a Bloom filter of them before the shuffle; nothing is collected."""
    names = stored.select(F.coalesce("stored", F.lit("")).alias("_name"), F.col("stored").isNull().alias("_null"))
    city = F.coalesce(F.col("city"), F.lit(""))
    return fact.join(names, (city == F.col("_name")) & (F.col("city").isNull() == F.col("_null")), "left_semi")


def filter_stored(
    fact: DataFrame,
    cities: Sequence[str] | DataFrame | None = None,
    categories: Sequence[str] | None = None,
    names_from: DataFrame | None = None,
) -> DataFrame:
    """Stored readings of the displayed cities and categories, by conditions on stored columns.

    Names are resolved to stored spellings first (in `names_from`, if its distinct cities are cheaper to read), so that
    the conditions reach the file scan and skip row groups; display names are left to compute for what is kept. Long lists
    and selections given as a DataFrame (`city`) are joined instead. `names_from` may have the stored names as `stored`
    beside what they are shown as (the kept table `spellings`).
    """
    def among(column: str, values: list[str | None]):
        held = F.col(column).isin([v for v in values if v is not None])
        return held | F.col(column).isNull() if None in values else held

    if cities is not None and not isinstance(cities, DataFrame) and len(cities) > LONG_LIST:
        cities = fact.sparkSession.createDataFrame([(c,) for c in cities], "city string")
    if isinstance(cities, DataFrame):
        fact = semi_filtered(fact, spelled_as(fact if names_from is None else names_from, cities))
    elif cities is not None:
        fact = fact.where(among("city", stored_spellings(fact if names_from is None else names_from, cities)))
    if categories is not None:
        fact = fact.where(among("aqi_category", [*categories, *([None] if UNKNOWN in categories else [])]))
    return fact
