"""Incremental ingest: every landed file once, clean, skip known readings, append.

Deduplication is against the stored table, not within an event-time watermark: a station may report
a measurement that is months old, and such a row is kept.

Every step of a batch can be run again: known keys are skipped, the small tables of its dates are computed from what is
stored, and replies that are set aside replace those of the same batch. A batch that was cut off is therefore repeated
whole, and each reading and each rejected reply is there once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from hazeworks.plans.load import load_raw
from hazeworks.plans.partials import Partials
from hazeworks.schemas import RAW_TEXT, RESPONSE
from hazeworks.sinks.fact import FactStore
from hazeworks.sources.files import typed_raw
from hazeworks.sources.landed import accepted, flatten, ingest, rejected


def _file_stream(
    spark: SparkSession, schema: StructType, landing: str, max_files: int | None, archive: str | None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(landing)


def stream_raw(
    spark: SparkSession, landing: str, max_files: int | None = None, archive: str | None = None,
) -> DataFrame:
    """Raw readings from a folder that fills with JSON Lines files."""
    return typed_raw(_file_stream(spark, RAW_TEXT, landing, max_files, archive))


def stream_responses(
    spark: SparkSession, landing: str, max_files: int | None = None, archive: str | None = None,
) -> DataFrame:
    """Raw readings from a folder that fills with landed replies; error replies are left out (see `stream_replies`)."""
    return ingest(stream_replies(spark, landing, max_files, archive))


def stream_replies(
    spark: SparkSession, landing: str, max_files: int | None = None, archive: str | None = None,
) -> DataFrame:
    """Station replies from a folder that fills with them, errors included."""
    return _file_stream(spark, RESPONSE, landing, max_files, archive)


def _start(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_ingest(
    raw: DataFrame, store: FactStore, checkpoint: str, *, every: str | None = None, partials: Partials | None = None,
) -> StreamingQuery:
    """Append the stream's new readings; one run over what has landed, or one per `every` interval.

    With `partials`, the small tables beside the store follow every batch.
    """
    store.create()

    def append(batch: DataFrame, _batch_id: int) -> None:
        load_raw(batch, store, allow_empty=True, partials=partials)

    return _start(raw, append, checkpoint, every)


def start_reply_ingest(
    replies: DataFrame, store: FactStore, quarantine: str, checkpoint: str, *, every: str | None = None,
    partials: Partials | None = None,
) -> StreamingQuery:
    """Both ways of every micro-batch of replies: readings of accepted ones to the store, rejected ones to a folder.

    The folder has a partition for each batch, which an attempt to run the batch again replaces. It belongs to the
    checkpoint, whose batch numbers it uses.
    """
    store.create()

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # parsed once; evicted or lost parts are read again from the same files
        try:
            rejected(batch).withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(quarantine)
            load_raw(flatten(accepted(batch)), store, allow_empty=True, partials=partials)
        finally:
            batch.unpersist()

    return _start(replies, split, checkpoint, every)


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """Rejected replies and the batch that brought them."""
    schema = StructType([*RESPONSE, StructField("batch", LongType())])
    return spark.read.schema(schema).parquet(quarantine)
