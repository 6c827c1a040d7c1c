"""Hourly averages of a stream by event time, and a table of what came too late for them.

Hours are Spark's own windowed aggregation: state per (city, hour) until the watermark passes the hour's end, then one row
in the file sink, which writes every batch once. Readings of hours that are closed already are dropped there and show up
in the metrics only, so a second query over the same files sums up all readings by city, hour and batch, each batch once.
What it has seen of a closed hour beyond what the hour counted came late.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazeworks.operators.clean import type_readings, valid_readings
from hazeworks.operators.prepare import city_name

_HOURS = "city string, hour timestamp, readings long, aqi_sum long"
_SEEN = f"{_HOURS}, newest timestamp, batch long"


def timed_readings(raw: DataFrame) -> DataFrame:
    """Valid readings that have a time: display city, time, AQI."""
    valid = valid_readings(type_readings(raw)).where(F.col("recorded_at").isNotNull())
    return valid.select(city_name(F.col("city")).alias("city"), F.col("recorded_at").cast("timestamp").alias("recorded_at"), "aqi")


@dataclass(frozen=True)
class HourlyStream:
    """The folders `hours` and `seen` of one stream, and its checkpoints."""

    spark: SparkSession
    folder: str
    delay: str = "2 hours"

    def start(self, raw: DataFrame, *, every: str | None = None) -> list[StreamingQuery]:
        """Both queries, over what has landed, or one batch per `every` interval. Restarts go on where they stopped."""
        self.spark.createDataFrame([], _HOURS).write.mode("ignore").parquet(f"{self.folder}/hours")
        self.spark.createDataFrame([], _SEEN).write.mode("ignore").partitionBy("batch").parquet(f"{self.folder}/seen")
        readings = timed_readings(raw)
        trigger = {"processingTime": every} if every else {"availableNow": True}
        hours = readings.withWatermark("recorded_at", self.delay).groupBy(
            F.window("recorded_at", "1 hour"), "city").agg(
            F.count("*").alias("readings"), F.sum("aqi").alias("aqi_sum")).select(
            "city", F.col("window.start").alias("hour"), "readings", "aqi_sum")
        summed = hours.writeStream.format("parquet").outputMode("append").option("path", f"{self.folder}/hours").option(
            "checkpointLocation", f"{self.folder}/checkpoints/hours").trigger(**trigger).start()
        seen = readings.writeStream.foreachBatch(self._note).option(
            "checkpointLocation", f"{self.folder}/checkpoints/seen").trigger(**trigger).start()
        return [summed, seen]

    def _note(self, batch: DataFrame, batch_id: int) -> None:
        """The sums of one batch, in place of those of an attempt that was cut off."""
        sums = batch.groupBy("city", F.date_trunc("hour", "recorded_at").alias("hour")).agg(
            F.count("*").alias("readings"), F.sum("aqi").alias("aqi_sum"), F.max("recorded_at").alias("newest"))
        sums.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.folder}/seen")

    def _closed(self) -> DataFrame:
        return self.spark.read.schema(_HOURS).parquet(f"{self.folder}/hours")

    def hours(self) -> DataFrame:
        """The closed hours: city, hour, readings, avg_aqi."""
        return self._closed().select("city", "hour", "readings", F.try_divide("aqi_sum", "readings").alias("avg_aqi"))

    def late(self) -> DataFrame:
        """(city, hour, readings, aqi_sum) that hours of the past did not count. Exact once both queries have read the
        same files; hours after the newest time less the delay are open and not looked at."""
        seen = self.spark.read.schema(_SEEN).parquet(f"{self.folder}/seen")
        closing = seen.agg(F.max("newest") - F.expr(f"INTERVAL {self.delay}") - F.expr("INTERVAL 1 HOUR")).scalar()
        all_ = seen.where(F.col("hour") <= closing).groupBy("city", "hour").agg(
            F.sum("readings").alias("readings"), F.sum("aqi_sum").alias("aqi_sum"))
        counted = self._closed().select("city", "hour", F.col("readings").alias("_readings"), F.col("aqi_sum").alias("_sum"))
        rest = F.col("readings") - F.coalesce("_readings", F.lit(0))
        return all_.join(counted, ["city", "hour"], "left").withColumn("readings", rest).where("readings > 0").select(
            "city", "hour", "readings", (F.col("aqi_sum") - F.coalesce("_sum", F.lit(0))).alias("aqi_sum"))
