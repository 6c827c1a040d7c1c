"""Averages over time: clock hours, and a window that ends at each reading.

Both start from sums per (city, time), which Spark combines in each task before they move, so a city or an instant that
holds a third of all readings costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeworks.operators.prepare import city_name


def time_sums(fact: DataFrame, instant: Column) -> DataFrame:
    """(city, at, readings, aqi_sum, aqi_rows) under display names; stored names are reduced first, and named then."""
    stored = fact.groupBy("city", instant.alias("at")).agg(
        F.count("*").alias("readings"), F.sum("aqi").alias("aqi_sum"), F.count("aqi").alias("aqi_rows"))
    return merged_sums(stored.withColumn("city", city_name(F.col("city"))))


def merged_sums(sums: DataFrame) -> DataFrame:
    """Sums of parts, added up."""
    return sums.groupBy("city", "at").agg(*[F.sum(c).alias(c) for c in ("readings", "aqi_sum", "aqi_rows")])


def averaged(sums: DataFrame) -> DataFrame:
    return sums.select("city", F.col("at").alias("hour"), "readings",
                       F.try_divide(F.col("aqi_sum"), F.col("aqi_rows")).alias("avg_aqi"))


def hourly_avg(fact: DataFrame, time: str = "recorded_at") -> DataFrame:
    """Readings and mean AQI of every city and clock hour; readings without a time share a null hour."""
    return averaged(time_sums(fact, F.date_trunc("hour", time)))


def rolling_avg(fact: DataFrame, time: str = "recorded_at", hours: int = 2, piece_hours: int = 24) -> DataFrame:
    """Per city and time: readings at that time and the mean AQI from `hours` before it up to it, both ends included.

    A city's times are cut into pieces that bring the `hours` before them along, so no task holds a city's whole
    history. A time is reported by its own piece only. Readings without a time have no window.
    """
    if not 0 < hours <= piece_hours:
        raise ValueError("a piece must be at least as long as the window")
    sums = time_sums(fact.where(F.col(time).isNotNull()), F.col(time))
    # Whole microseconds: windows by number, which hold for times without a zone as well.
    micros = F.unix_micros(F.col("at").cast("timestamp"))
    piece, span = piece_hours * 3_600_000_000, hours * 3_600_000_000
    timed = sums.withColumn("_at", micros).withColumn("_own", F.floor(F.col("_at") / piece).cast("long"))
    # The last `hours` of a piece are also the lead-in of the next one.
    next_too = F.floor((F.col("_at") + span) / piece).cast("long")
    pieces = timed.withColumn("_piece", F.explode(F.array_distinct(F.array("_own", next_too))))
    over = f"OVER (PARTITION BY city, _piece ORDER BY _at RANGE BETWEEN {span} PRECEDING AND CURRENT ROW)"
    return pieces.withColumns({
        "_sum": F.expr(f"sum(aqi_sum) {over}"), "_rows": F.expr(f"sum(aqi_rows) {over}"),
    }).where(F.col("_piece") == F.col("_own")).select(
        "city", F.col("at").alias(time), "readings", F.try_divide("_sum", "_rows").alias("rolling_avg"))


def alert_flags(latest: DataFrame) -> DataFrame:
    """What a city's current levels call for. The limits are fixed values of the operating guidance."""
    return latest.select(
        "city", "aqi", "pm25",
        F.coalesce(F.col("aqi") > 100, F.lit(False)).alias("mitigation"),
        F.coalesce(F.col("aqi") > 150, F.lit(False)).alias("advisory"),
        F.coalesce(F.col("pm25") > 35, F.lit(False)).alias("filtration"))
