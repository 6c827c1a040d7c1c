"""Landed station replies: read, split by status, flatten to raw readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeworks.functions import strip
from hazeworks.schemas import DEFAULT_FEED, POLLUTANTS, RESPONSE


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """One JSON reply per line, with the `feed` it was asked for."""
    return spark.read.schema(RESPONSE).json(path)


def parse_responses(documents: DataFrame, column: str = "document") -> DataFrame:
    """Replies held as JSON text in a column. A malformed part becomes null, not an error."""
    # Through a generator, so that a filter on the parts is not pushed below and parsed a second time.
    return documents.select(F.inline(F.array(F.from_json(column, RESPONSE))))


def _is_ok() -> Column:
    return F.col("status").eqNullSafe("ok")


def accepted(responses: DataFrame) -> DataFrame:
    return responses.where(_is_ok())


def rejected(responses: DataFrame) -> DataFrame:
    """Replies to set aside: any status other than ok, a missing one included."""
    return responses.where(~_is_ok())


def flatten(responses: DataFrame) -> DataFrame:
    """Accepted replies to raw readings; missing levels give null, a missing name gives the feed."""
    name = F.coalesce("data.city.name", "feed")
    return responses.select(
        name.alias("city"),
        name.alias("station"),
        F.col("data.aqi").alias("aqi"),
        *[F.col("data.iaqi")[p]["v"].try_cast("double").alias(p) for p in POLLUTANTS],
        F.col("data.dominentpol").alias("dominant_pollutant"),
        F.col("data.time.iso").alias("recorded_at"),
    )


def ingest(responses: DataFrame) -> DataFrame:
    return flatten(accepted(responses))


def feed_tokens(config: Column) -> Column:
    """Feeds in a comma-separated setting: stripped, blanks dropped; unset means the default feed."""
    tokens = F.split(F.coalesce(config, F.lit(DEFAULT_FEED)), ",")
    return F.filter(F.transform(tokens, strip), lambda token: token != "")


def feed_list(settings: DataFrame, column: str) -> DataFrame:
    """One row per feed of every setting, in order (`position` counts from 0)."""
    kept = [F.col(c) for c in settings.columns if c != column]
    return settings.select(*kept, F.posexplode(feed_tokens(F.col(column))).alias("position", "feed"))
