"""Time series, newest-first lists and the log table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.operators.topk import first_rows
from hazeworks.schemas import POLLUTANT_LABELS, check_pollutant

# The column headings of the log table.
LOG_HEADINGS = {
    "fetched_at": "Ingestion Timestamp",
    "recorded_at": "Measurement Timestamp",
    "city": "Location",
    "station": "Station ID",
    "aqi": "AQI",
    "aqi_category": "Classification",
    "dominant_pollutant": "Primary Pollutant",
}
# How many rows the log shows by default, and a recent view.
LOG_SIZE = 100
RECENT_LIMIT = 2000


def recent_readings(readings: DataFrame, limit: int | None = RECENT_LIMIT) -> DataFrame:
    """The newest rows by ingestion time; every task keeps at most `limit` rows. None keeps all."""
    if limit is None:
        return readings
    order = [F.col("fetched_at").desc_nulls_last(), F.col("recorded_at").desc_nulls_last(), "city", "station"]
    return first_rows(readings, order, limit)


def log_table(recent: DataFrame, pollutant: str = "pm25") -> DataFrame:
    """The eight display columns of the log, with the chosen pollutant.

    Stored levels are floats; read as a double, 71.7 would show as 71.69999694824219. The shortest text of a float is
    what the source had.
    """
    check_pollutant(pollutant)
    headings = list(LOG_HEADINGS.items())
    headings.insert(-1, (pollutant, POLLUTANT_LABELS[pollutant]))

    def shown(name: str):
        if name == pollutant and recent.schema[name].dataType.simpleString() in ("float", "double"):
            return F.col(name).cast("float").cast("string").cast("double")
        return F.col(name)

    return recent.select(*[shown(name).alias(heading) for name, heading in headings])


def time_series(readings: DataFrame, ordered: bool = True) -> DataFrame:
    """AQI over ingestion time, per city.

    The total order is for presentation. Its tie-breakers let range partitioning split a load whose
    rows all carry one ingestion time; `ordered=False` leaves the sort (and its shuffle) out.
    """
    if ordered:
        readings = readings.orderBy(
            F.col("fetched_at").asc_nulls_last(), "city", F.col("recorded_at").asc_nulls_last(), "aqi")
    return readings.select("fetched_at", "aqi", "city")


def city_series(readings: DataFrame, city: str, pollutant: str) -> DataFrame:
    """One pollutant of one city over time; no rows unless the city has more than one reading."""
    check_pollutant(pollutant)
    rows = readings.where(F.col("city") == city)
    enough = rows.select("city").limit(2).agg(F.count("*") > 1).scalar()
    return (
        rows.where(enough)
        .orderBy(F.col("fetched_at").asc_nulls_last(), F.col("recorded_at").asc_nulls_last(), "station")
        .select("fetched_at", F.col(pollutant).alias("value"))
    )
