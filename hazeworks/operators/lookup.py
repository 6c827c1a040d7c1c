"""Lookups in the category and pollutant dimensions, whose size is fixed (six and five rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.functions import label_unit
from hazeworks.schemas import DEFAULT_COLOR, category_dimension, pollutant_dimension


def with_category_color(readings: DataFrame) -> DataFrame:
    """Display colour of each row's category; an unknown category gets the neutral colour."""
    colors = category_dimension(readings.sparkSession).select(
        F.col("category").alias("aqi_category"), "color")
    joined = readings.join(F.broadcast(colors), "aqi_category", "left")
    return joined.select(*readings.columns, F.coalesce("color", F.lit(DEFAULT_COLOR)).alias("color"))


def with_pollutant_name(values: DataFrame) -> DataFrame:
    """Full name and unit for rows that carry a pollutant code."""
    names = pollutant_dimension(values.sparkSession).select(
        "pollutant", "name", label_unit(F.col("label")).alias("unit"))
    joined = values.join(F.broadcast(names), "pollutant", "left")
    return joined.select(*values.columns, "name", "unit")
