"""The stored readings: a Parquet table partitioned by measurement date, append-only by key."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from hazeworks.operators.dedup import dedup_readings
from hazeworks.operators.keys import without_key
from hazeworks.operators.quality import require_rows
from hazeworks.operators.upsert import new_readings
from hazeworks.schemas import FACT, PARTITION_COLUMN, READING_COLUMNS


@dataclass(frozen=True)
class BatchDates:
    """Measurement dates of a batch and its row count: what the pruning of the table needs."""

    rows: int
    dates: tuple[date, ...]
    undated: bool

    def partition_filter(self) -> Column:
        column = F.col(PARTITION_COLUMN)
        dated = column.isin(list(self.dates))
        return (dated | column.isNull()) if self.undated else dated


@dataclass(frozen=True)
class LoadResult:
    batch_rows: int
    inserted_rows: int

    @property
    def skipped_rows(self) -> int:
        return self.batch_rows - self.inserted_rows


def batch_dates(batch: DataFrame) -> BatchDates:
    """One small action: the batch is aggregated to one row per date, then to one row."""
    per_date = batch.groupBy(F.to_date("recorded_at").alias("day")).agg(F.count("*").alias("rows"))
    row = per_date.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count_if(F.col("day").isNull()).alias("n_undated"),
        # One entry per calendar day at most: a century has 36,525.
        F.collect_set("day").alias("days"),
    ).first()
    return BatchDates(row["rows"], tuple(sorted(row["days"])), row["n_undated"] > 0)


@dataclass(frozen=True)
class FactStore:
    """Stored readings under a catalog table name, or under a path where there is no catalog."""

    spark: SparkSession
    path: str
    table: str | None = None

    def create(self) -> None:
        """Create the empty table unless it exists."""
        if self.table is None:
            empty = self.spark.createDataFrame([], FACT)
            empty.write.mode("ignore").partitionBy(PARTITION_COLUMN).parquet(self.path)
            return
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACT)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING parquet "
            f"PARTITIONED BY ({PARTITION_COLUMN}) LOCATION :place", args={"place": self.path})

    def _stored(self) -> DataFrame:
        if self.table is None:
            return self.spark.read.schema(FACT).parquet(self.path)
        return self.spark.table(self.table)

    def read(self) -> DataFrame:
        """The twelve reading columns. Filter on `recorded_date` (see `read_dates`) to skip files."""
        return self._stored().select(*READING_COLUMNS)

    def read_dates(self, dates: BatchDates) -> DataFrame:
        return self._stored().where(dates.partition_filter()).select(*READING_COLUMNS)

    def append_new(
        self,
        batch: DataFrame,
        *,
        fetched_at: datetime | None = None,
        dates: BatchDates | None = None,
        allow_empty: bool = False,
    ) -> LoadResult:
        """Append the clean readings whose key is not stored yet, each key once. Assumes one writer at a time.

        Of readings that share a key in the batch, the first in a fixed order is stored; the others count as skipped.

        Re-running a load that was cut off is safe: the keys it did write are skipped. `fetched_at`
        stamps the batch unless the batch brings its own; the default is the time of the write.
        """
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
            raise ValueError(f"partition dates are UTC dates, but the session time zone is {zone}")
        if not isinstance(batch.schema["recorded_at"].dataType, TimestampType):
            batch = without_key(batch).withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
        dates = dates or batch_dates(batch)
        if dates.rows == 0 and allow_empty:
            return LoadResult(0, 0)
        require_rows(dates.rows, "clean readings")
        if "fetched_at" not in batch.columns:
            stamp = F.lit(fetched_at).cast("timestamp") if fetched_at else F.current_timestamp()
            batch = batch.withColumn("fetched_at", stamp)
        unique = dedup_readings(batch, keep_key=True)
        fresh = new_readings(unique, self.read_dates(dates)).withColumn(
            PARTITION_COLUMN, F.to_date("recorded_at")
        ).select(*[F.col(field.name).cast(field.dataType) for field in FACT])
        inserted = Observation()
        # Rebalance: few files for a quiet date, several tasks for a date that holds much of the batch.
        # The city order narrows the row-group statistics that city filters prune by.
        placed = (
            fresh.hint("rebalance", PARTITION_COLUMN)
            .sortWithinPartitions(PARTITION_COLUMN, "city", "recorded_at")
            .observe(inserted, F.count("*").alias("rows"))
        )
        if self.table is None:
            placed.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(self.path)
        else:
            placed.write.mode("append").insertInto(self.table)
        return LoadResult(dates.rows, inserted.get["rows"])


def write_jdbc(readings: DataFrame, options: dict[str, str], table: str, writers: int = 16) -> None:
    """Append to a database table with a bounded number of connections; nothing is deduplicated."""
    readings.repartition(writers).write.format("jdbc").options(**options).options(
        dbtable=table, batchsize=10_000).mode("append").save()
