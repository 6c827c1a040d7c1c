"""Single-row and per-category summaries of a selection of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeworks.functions import date_text, time_text


def kpi_summary(readings: DataFrame) -> DataFrame:
    return readings.agg(
        F.avg("aqi").alias("avg_aqi"),
        F.max("pm25").alias("peak_pm25"),
        F.count("*").alias("records"),
    )


def rounded(kpis: DataFrame) -> DataFrame:
    """A KPI row as shown: one decimal, halves to even."""
    return kpis.select(
        F.bround("avg_aqi", 1).alias("avg_aqi"), F.bround("peak_pm25", 1).alias("peak_pm25"), "records")


def kpi_rounded(readings: DataFrame) -> DataFrame:
    return rounded(kpi_summary(readings))


def shown_freshness(summary: DataFrame) -> DataFrame:
    seen = F.col("last_seen")
    return summary.select("last_seen", date_text(seen).alias("seen_date"), time_text(seen).alias("seen_time"))


def freshness(readings: DataFrame) -> DataFrame:
    return shown_freshness(readings.agg(F.max("fetched_at").alias("last_seen")))


def network_coverage(names: DataFrame) -> DataFrame:
    """Exact number of cities and stations.

    Give it rows that are distinct already where possible (see `plans.dashboard`): the two distinct
    counts expand every input row.
    """
    return names.agg(
        F.count_distinct("city").alias("cities"),
        F.count_distinct("station").alias("stations"),
    )


def network_coverage_approx(readings: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Sketched counts: fixed-size state per task, no shuffle of names. For readings under their stored names: a
    display name for every row would cost more than the exact count, so spellings count apart."""
    return readings.agg(
        F.approx_count_distinct("city", rsd).alias("cities"),
        F.approx_count_distinct("station", rsd).alias("stations"),
    )


def category_distribution(readings: DataFrame) -> DataFrame:
    """Readings per category and their share, most frequent first."""
    # The unpartitioned window runs on the handful of rows left after the aggregation.
    total = F.sum("readings").over(Window.partitionBy())
    return (
        readings.groupBy(F.col("aqi_category").alias("category"))
        .agg(F.count("*").alias("readings"))
        .withColumn("share", F.col("readings") / total)
        .orderBy(F.col("readings").desc(), "category")
    )


BASELINE_AGE = "INTERVAL 1 HOUR"
BASELINE_MIN_ROWS = 10


def trend_row(averages: DataFrame) -> DataFrame:
    """Trend from `records`, `current_avg` and `older_avg`; 0 without a positive baseline."""
    current, previous = F.col("current_avg"), F.col("previous_avg")
    change = F.when(previous > 0, (current - previous) / previous * 100).otherwise(0.0)
    baseline = F.when(F.col("records") > BASELINE_MIN_ROWS, F.col("older_avg")).otherwise(current)
    return averages.select("records", "current_avg", baseline.alias("previous_avg")).withColumn("trend_pct", change)


def aqi_trend(readings: DataFrame) -> DataFrame:
    """Mean AQI against the mean of rows more than an hour older than the newest row.

    The current mean covers all rows. With ten rows or fewer, or without a positive baseline, the
    trend is 0. The newest time is a scalar subquery over the same two columns as the main
    aggregation, so Spark can reuse one shuffle for both when the input itself is shuffled.
    """
    base = readings.select("fetched_at", "aqi")
    overall = base.agg(
        F.struct(
            F.max("fetched_at").alias("last_seen"),
            F.count("*").alias("records"),
            F.avg("aqi").alias("current_avg"),
        ).alias("overall")
    )
    cutoff = overall.scalar()["last_seen"] - F.expr(BASELINE_AGE)
    older = base.agg(F.avg(F.when(F.col("fetched_at") < cutoff, F.col("aqi"))).alias("older_avg"))
    return trend_row(older.select("older_avg", overall.scalar().alias("o")).select("older_avg", "o.*"))


def aqi_trend_flag(trend: DataFrame) -> DataFrame:
    """Direction and size of the trend; no change counts as down."""
    return trend.select(
        F.when(F.col("trend_pct") > 0, "up").otherwise("down").alias("direction"),
        F.abs("trend_pct").alias("change_pct"),
    )
