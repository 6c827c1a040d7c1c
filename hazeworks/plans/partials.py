"""Small tables kept beside the stored readings, so that a refresh does not read the history again.

Tables partitioned by measurement date like the readings: the rollup, the newest readings, row counts per hour of
ingestion, sums per city and measured hour, the spellings of city names, and sketches of what is covered. After a load the dates it touched are computed anew from the stored readings and replaced. An update that
was cut off is simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeworks.operators.hourly import averaged, merged_sums, time_sums
from hazeworks.operators.prepare import city_name
from hazeworks.operators.rollup import coverage_sketches, rollup, sketched_coverage
from hazeworks.operators.series import recent_readings
from hazeworks.plans.dashboard import newest_readings
from hazeworks.schemas import PARTITION_COLUMN
from hazeworks.sinks.fact import BatchDates, FactStore, batch_dates


def hour_counts(fact: DataFrame, *within: str) -> DataFrame:
    return fact.groupBy(*within, F.date_trunc("hour", "fetched_at").alias("hour")).agg(F.count("*").alias("rows"))


def spellings(fact: DataFrame, *within: str) -> DataFrame:
    """(stored, city): the stored city names and what they are shown as."""
    stored = fact.select(*within, F.col("city").alias("stored")).distinct()
    return stored.withColumn("city", city_name(F.col("stored")))


def recent_cutoff(hours: DataFrame, limit: int) -> datetime | None:
    """The hour from which on the newest `limit` readings lie; None if fewer readings are dated.

    Every hour listed has a reading, so `limit` hours are enough to look at.
    """
    newest = hours.where(F.col("hour").isNotNull()).groupBy("hour").agg(F.sum("rows").alias("rows"))
    seen = 0
    for row in newest.orderBy(F.col("hour").desc()).limit(limit).collect():
        seen += row["rows"]
        if seen >= limit:
            return row["hour"]
    return None


@dataclass(frozen=True)
class Partials:
    """The tables `rollup`, `newest`, `hours`, `measured`, `spellings` and `sketches` below one folder."""

    store: FactStore
    folder: str

    def update(self, dates: BatchDates) -> None:
        """Replace what is kept of some dates (a load's, from `sinks.fact.batch_dates`)."""
        fact = self.store.read_dates(dates).withColumn(PARTITION_COLUMN, F.to_date("recorded_at"))
        measured = time_sums(fact, F.date_trunc("hour", "recorded_at"))
        for name, rows in (("rollup", rollup(fact, PARTITION_COLUMN)), ("newest", newest_readings(fact, PARTITION_COLUMN)),
                           ("hours", hour_counts(fact, PARTITION_COLUMN)), ("spellings", spellings(fact, PARTITION_COLUMN)),
                           ("measured", measured.withColumn(PARTITION_COLUMN, F.to_date("at")))):
            self._replace(name, rows)
        # From the rollup just written, not from the readings again.
        kept = self._stored("rollup").where(dates.partition_filter())
        self._replace("sketches", coverage_sketches(kept, PARTITION_COLUMN))

    def rebuild(self) -> None:
        """All dates anew, as if every table were lost."""
        fact = self.store.read()
        self.update(batch_dates(fact))

    def _replace(self, name: str, rows: DataFrame) -> None:
        rows.repartition(PARTITION_COLUMN).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COLUMN).parquet(f"{self.folder}/{name}")

    def _stored(self, name: str) -> DataFrame:
        return self.store.spark.read.parquet(f"{self.folder}/{name}")

    def read(self, name: str) -> DataFrame:
        return self._stored(name).drop(PARTITION_COLUMN)

    def hourly_avg(self) -> DataFrame:
        """Mean AQI per city and measured hour; see `operators.hourly`."""
        return averaged(merged_sums(self.read("measured")))

    def coverage(self, first: date | None = None, last: date | None = None, by: Column | None = None) -> DataFrame:
        """Estimated numbers of cities and stations of a range of dates, by `by` of the date if given. One row a date is read."""
        rows, day = self._stored("sketches"), F.col(PARTITION_COLUMN)
        rows = rows if first is None else rows.where(day >= F.lit(first))
        rows = rows if last is None else rows.where(day <= F.lit(last))
        return sketched_coverage(rows, *([] if by is None else [by]))

    def recent_readings(self, limit: int) -> DataFrame:
        """The newest readings. The cutoff from the hour counts reaches the file scan; older row groups are skipped."""
        fact, cutoff = self.store.read(), recent_cutoff(self.read("hours"), limit)
        return recent_readings(fact if cutoff is None else fact.where(F.col("fetched_at") >= F.lit(cutoff)), limit)
