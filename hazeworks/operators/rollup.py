"""Counts and sums per (city, station, category): one scan that answers several monitoring tables.

The rollup is grouped by stored names with fixed-width state, so it is a hash aggregation whose size
follows the network, not the history. Names and selections are then applied to its few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from hazeworks.operators.prepare import category_label, city_name, station_name
from hazeworks.operators.summary import BASELINE_AGE, trend_row

#: Binary logarithm of a sketch's registers: a standard error of about 0.8 %, in 16 KB at most.
SKETCH_SIZE = 14


def rollup(fact: DataFrame, *within: str) -> DataFrame:
    """Partial aggregates of the stored readings under their display names, not merged by them.

    `within` are further columns to group by. What is read off a rollup adds its rows up, so rollups of parts of the
    table, one below the other, serve as the rollup of all.
    """
    dated_aqi = F.when(F.col("fetched_at").isNotNull(), F.col("aqi"))
    stored = fact.groupBy(*within, "city", "station", "aqi_category").agg(
        F.count("*").alias("records"),
        F.sum("aqi").alias("aqi_sum"),
        F.count("aqi").alias("aqi_rows"),
        F.max("pm25").alias("peak_pm25"),
        F.max("fetched_at").alias("last_seen"),
        # Of rows with an ingestion time only: what the trend's baseline can be taken from.
        F.sum(dated_aqi).alias("dated_aqi_sum"),
        F.count(dated_aqi).alias("dated_aqi_rows"),
    )
    named = stored.withColumn("city", city_name(F.col("city")))
    return named.withColumns({
        "station": station_name(F.col("station"), F.col("city")),
        "aqi_category": category_label(F.col("aqi_category")),
    })


def overview(partials: DataFrame) -> DataFrame:
    """KPI row, network coverage and freshness of a (selected) rollup."""
    return partials.agg(
        F.try_divide(F.sum("aqi_sum"), F.sum("aqi_rows")).alias("avg_aqi"),
        F.max("peak_pm25").cast("double").alias("peak_pm25"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.max("last_seen").alias("last_seen"),
        F.count_distinct("city").alias("cities"),
        F.count_distinct("station").alias("stations"),
    )


def coverage_sketches(partials: DataFrame, *within: str) -> DataFrame:
    """Mergeable sketches of the displayed cities and stations of a rollup."""
    return partials.groupBy(*within).agg(
        F.hll_sketch_agg("city", SKETCH_SIZE).alias("cities"), F.hll_sketch_agg("station", SKETCH_SIZE).alias("stations"))


def sketched_coverage(sketches: DataFrame, *by: Column) -> DataFrame:
    """Estimates from the union of sketches, without what they were made of."""
    return sketches.groupBy(*by).agg(*[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in ("cities", "stations")])


def trend(partials: DataFrame, readings: DataFrame) -> DataFrame:
    """The trend of `summary.aqi_trend`, with rows read for the newest hour only.

    What is older is the rollup's total less that hour, which is exact for whole AQI numbers. The
    cutoff is a scalar subquery, so that its value reaches the file scan and skips older row groups.
    """
    if not isinstance(partials.schema["aqi_sum"].dataType, IntegralType):
        raise TypeError("the trend over a rollup needs whole AQI numbers; use summary.aqi_trend")
    totals = partials.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.try_divide(F.sum("aqi_sum"), F.sum("aqi_rows")).alias("current_avg"),
        F.sum("dated_aqi_sum").alias("dated_sum"),
        F.sum("dated_aqi_rows").alias("dated_rows"),
    )
    cutoff = partials.agg(F.max("last_seen") - F.expr(BASELINE_AGE)).scalar()
    recent = readings.where(F.col("fetched_at") >= cutoff).agg(
        F.coalesce(F.sum("aqi"), F.lit(0)).alias("recent_sum"), F.count("aqi").alias("recent_rows"))
    # Two single rows side by side. A second scalar subquery over the rollup would be merged with the
    # cutoff's into one struct, whose field is no longer a value the scan can filter by.
    rows = totals.unionByName(recent, allowMissingColumns=True)
    both = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    older = F.try_divide(F.col("dated_sum") - F.col("recent_sum"), F.col("dated_rows") - F.col("recent_rows"))
    return trend_row(both.withColumn("older_avg", older))


def distribution(partials: DataFrame) -> DataFrame:
    """Readings per category and their share, as `summary.category_distribution` gives them."""
    total = F.sum("readings").over(Window.partitionBy())
    return (
        partials.groupBy(F.col("aqi_category").alias("category"))
        .agg(F.sum("records").alias("readings"))
        .withColumn("share", F.col("readings") / total)
        .orderBy(F.col("readings").desc(), "category")
    )
