"""Stored readings to the analysis form: coerced types, display names, no missing labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeworks.functions import display_name, to_instant, to_number
from hazeworks.schemas import POLLUTANTS, UNKNOWN


def city_name(city: Column) -> Column:
    return display_name(city)


def station_name(station: Column, city: Column) -> Column:
    """Display name of the station; a missing one takes the city's display name."""
    return display_name(F.coalesce(station, city))


def category_label(category: Column) -> Column:
    return F.coalesce(category, F.lit(UNKNOWN))


def stored_names(fact: DataFrame) -> DataFrame:
    """(text, name): the display name of every distinct stored city and station, each text once."""
    pairs = fact.select("city", "station").distinct()
    texts = pairs.select(F.explode(F.array("city", "station")).alias("text")).where(F.col("text").isNotNull()).distinct()
    return texts.select("text", display_name(F.col("text")).alias("name"))


def _with_names(fact: DataFrame, names: DataFrame | None) -> DataFrame:
    # In two steps, so that the city's name is computed once and serves both columns.
    if names is None:
        named = fact.withColumn("city", city_name(F.col("city")))
        return named.withColumn("station", station_name(F.col("station"), F.col("city")))
    # A list that the caller kept may hold a text twice; readings must not multiply.
    known = names.groupBy(F.col("text").alias("_text")).agg(F.min("name").alias("_name"))

    def look_up(readings: DataFrame, column: str, otherwise: Column) -> DataFrame:
        found = readings.join(known, F.col(column) == F.col("_text"), "left")
        return found.withColumn(column, F.coalesce("_name", otherwise)).drop("_text", "_name")

    named = look_up(fact, "city", city_name(F.col("city")))
    return look_up(named, "station", station_name(F.col("station"), F.col("city")))


def prepare(fact: DataFrame, names: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """All columns of the stored readings in their analysis form, and those to keep as they are, unfiltered. No shuffle without `names`.

    A display name takes several string operations. With `names` (see `stored_names`) they are looked up and only
    what is not listed is computed; the result is the same. Spark broadcasts the list where it is small enough, and
    joins by shuffle where it is not.
    """
    types = {field.name: field.dataType for field in fact.schema}
    return _with_names(fact, names).select(
        *keep,
        "city",
        "station",
        *[to_number(name, types[name]).alias(name) for name in ("aqi", *POLLUTANTS)],
        category_label(F.col("aqi_category")).alias("aqi_category"),
        F.col("dominant_pollutant"),
        to_instant("recorded_at", types["recorded_at"]).alias("recorded_at"),
        to_instant("fetched_at", types["fetched_at"]).alias("fetched_at"),
    )
