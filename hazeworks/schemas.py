"""Schemas of the stages a reading passes through, and the two small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Pollutants in display order, with full name and axis label.
POLLUTANT_ROWS = (
    ("pm25", "Particulate Matter 2.5", "PM2.5 (µg/m³)"),
    ("pm10", "Particulate Matter 10", "PM10 (µg/m³)"),
    ("o3", "Ozone", "Ozone (ppb)"),
    ("no2", "Nitrogen Dioxide", "NO₂ (ppb)"),
    ("co", "Carbon Monoxide", "CO (ppm)"),
)
# AQI bands with inclusive bounds and display colour.
CATEGORY_ROWS = (
    ("Good", 0, 50, "#00a65a"),
    ("Moderate", 51, 100, "#f39c12"),
    ("Unhealthy for Sensitive Groups", 101, 150, "#f09300"),
    ("Unhealthy", 151, 200, "#dd4b39"),
    ("Very Unhealthy", 201, 300, "#8e44ad"),
    ("Hazardous", 301, 500, "#7f1d1d"),
)
# What a lookup falls back to, and the feed polled when none is configured.
DEFAULT_CATEGORY = "Hazardous"
DEFAULT_COLOR = "#7f8c8d"
DEFAULT_FEED = "@1451"
UNKNOWN = "Unknown"
NOT_AVAILABLE = "N/A"

POLLUTANTS = tuple(row[0] for row in POLLUTANT_ROWS)
POLLUTANT_LABELS = {row[0]: row[2] for row in POLLUTANT_ROWS}

# A station's reply as landed. Numbers stay text: some come quoted, some are placeholders.
RESPONSE = T.StructType([
    T.StructField("feed", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("aqi", T.StringType()),
        T.StructField("city", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("iaqi", T.MapType(
            T.StringType(), T.StructType([T.StructField("v", T.StringType())]))),
        T.StructField("dominentpol", T.StringType()),
        T.StructField("time", T.StructType([T.StructField("iso", T.StringType())])),
    ])),
])

RAW = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("station", T.StringType()),
    T.StructField("aqi", T.StringType()),
    *[T.StructField(name, T.DoubleType()) for name in POLLUTANTS],
    T.StructField("dominant_pollutant", T.StringType()),
    T.StructField("recorded_at", T.StringType()),
])

# Raw readings as files hold them: numbers as text, quoted or not.
RAW_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW])

CLEAN = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("station", T.StringType()),
    T.StructField("aqi", T.IntegerType()),
    *[T.StructField(name, T.FloatType()) for name in POLLUTANTS],
    T.StructField("aqi_category", T.StringType()),
    T.StructField("dominant_pollutant", T.StringType()),
    T.StructField("recorded_at", T.TimestampType()),
])

# Every clean value as text, the exchange format between separate jobs.
CLEAN_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in CLEAN])

PARTITION_COLUMN = "recorded_date"
FACT = T.StructType([
    *CLEAN.fields,
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField(PARTITION_COLUMN, T.DateType()),
])

CLEAN_COLUMNS = tuple(CLEAN.names)
READING_COLUMNS = (*CLEAN_COLUMNS, "fetched_at")
KEY_COLUMNS = ("city", "recorded_at")


def check_pollutant(name: str) -> str:
    if name not in POLLUTANTS:
        raise ValueError(f"unknown pollutant {name!r}, expected one of {', '.join(POLLUTANTS)}")
    return name


def _inline_table(spark: SparkSession, rows, columns: str) -> DataFrame:
    # An inline VALUES table keeps exact statistics, so its broadcast has a known size.
    values = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS dimension({columns})")


def category_dimension(spark: SparkSession) -> DataFrame:
    return _inline_table(spark, CATEGORY_ROWS, "category, low, high, color")


def pollutant_dimension(spark: SparkSession) -> DataFrame:
    return _inline_table(spark, POLLUTANT_ROWS, "pollutant, name, label")
