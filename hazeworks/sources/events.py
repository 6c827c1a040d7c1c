"""Readings derived from the `events` test table, so that every query grows with the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeworks.schemas import POLLUTANTS

READINGS_SQL = """
SELECT event_id AS reading_id,
 CASE WHEN user_id % 40 = 39 THEN NULL
      ELSE concat(repeat(' ', CAST(user_id % 3 AS INT)),
                  CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END,
                  ' (zone?? ', CAST(user_id % 8 AS STRING), ') ') END AS city,
 CASE WHEN user_id % 25 = 0 THEN NULL ELSE concat(' station  ', CAST(user_id AS STRING)) END AS station,
 CASE WHEN event_id % 17 = 0 THEN '-' ELSE CAST(value AS STRING) END AS aqi,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS pm25,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 0.5 END AS pm10,
 CASE WHEN event_id % 4 = 0 THEN NULL ELSE value * 0.25 END AS o3,
 value * 0.125 AS no2,
 CASE WHEN event_id % 7 = 0 THEN value * 0.0625 ELSE NULL END AS co,
 CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'pm25' ELSE 'o3' END AS dominant_pollutant,
 date_trunc('hour', ts) AS recorded_at,
 ts AS fetched_at
FROM {events}
"""


def readings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings over the whole table, with `reading_id` and `fetched_at`."""
    # The table's times carry no zone and mean UTC; a caller's session may be set otherwise.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    raw = spark.sql(READINGS_SQL.format(events="{events}"), events=events)
    return raw.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))


def responses_from_readings(readings: DataFrame) -> DataFrame:
    """The same readings as landed JSON replies; every 13th is an error reply with a text body, every 5th quotes its
    numbers."""
    def ok(kind: str):
        measured = F.create_map(*[
            item for p in POLLUTANTS for item in (F.lit(p), F.struct(F.col(p).cast(kind).alias("v")))])
        return F.to_json(F.struct(
            F.col("station").alias("feed"),
            F.lit("ok").alias("status"),
            F.struct(
                "aqi",
                F.struct(F.col("city").alias("name")).alias("city"),
                F.map_filter(measured, lambda _, value: value["v"].isNotNull()).alias("iaqi"),
                F.col("dominant_pollutant").alias("dominentpol"),
                F.struct(F.date_format("recorded_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("iso")).alias("time"),
            ).alias("data"),
        ))

    error = F.struct(
        F.col("station").alias("feed"), F.lit("error").alias("status"), F.lit("Unknown station").alias("data"))
    failed = F.col("reading_id") % 13 == 0
    quoted = F.col("reading_id") % 5 == 0
    return readings.select(F.when(failed, F.to_json(error)).when(quoted, ok("string")).otherwise(ok("double")).alias(
        "document"))
