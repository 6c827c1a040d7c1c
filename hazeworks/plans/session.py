"""Session settings for cluster-size runs."""

from __future__ import annotations

import math
import os
import shlex

from pyspark import SparkConf
from pyspark.sql import SparkSession

_SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Reduce tasks for about 256 MB each, two per core at least; adaptive execution merges what is too many.

    The driver keeps one status per map task whose size grows with this number, so many tens of thousands of both need
    a large driver. That is the caller's to weigh: a number set on the session is left alone.
    """
    return max(2 * cores, math.ceil(shuffled_bytes / _SHUFFLE_TARGET_BYTES))


def configure(
    builder: SparkSession.Builder, *, shuffled_bytes: int | None = None, cores: int | None = None,
) -> SparkSession.Builder:
    """Settings for the operators here. What spark-submit or a configuration file sets stays as it is.

    The number of shuffle partitions is only chosen when the caller tells the shuffled bytes (and cores).
    """
    settings = {
        # Times are compared and shown in UTC.
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": True,
        "spark.sql.adaptive.skewJoin.enabled": True,
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": True,
        "spark.sql.files.maxPartitionBytes": 256 * 1024 * 1024,
        # How large a rebalanced partition (and so a written file) gets before compression.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": 256 * 1024 * 1024,
        "spark.sql.parquet.compression.codec": "zstd",
        # The default, INT96, has no statistics: time filters could not skip row groups.
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        # Partial results of a malformed reply: keep its status, null the rest.
        "spark.sql.json.enablePartialResults": True,
    }
    if shuffled_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = shuffle_partitions(shuffled_bytes, cores or 1)
    given = _given() | set(getattr(builder, "_options", {}))
    for key, value in settings.items():
        if key not in given:
            builder = builder.config(key, value)
    return builder


def _given() -> set[str]:
    """Settings that came with the process: of spark-submit, or of PYSPARK_SUBMIT_ARGS."""
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # the JVM is there already; to ask starts nothing
        return {key for key, _ in SparkConf().getAll()}
    words = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    return {setting.partition("=")[0] for flag, setting in zip(words, words[1:]) if flag in ("--conf", "-c")}
