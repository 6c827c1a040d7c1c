"""One reading per (city, measurement time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeworks.operators.keys import KEY_PARTS, with_key, without_key
from hazeworks.schemas import KEY_COLUMNS


def dedup_readings(
    readings: DataFrame, tie_breaker: Sequence[str] = (), *, keep_key: bool = False,
) -> DataFrame:
    """Keep one row per key; null keys count as equal.

    The survivor is the first row by `tie_breaker` (columns that identify a reading) or, without one,
    by all remaining columns, so that re-running a lost task gives the same rows. `row_number() = 1`
    makes Spark limit every key to one row before the shuffle, so a key that holds a third of all rows
    sends one row per map task. With `keep_key` a following `new_readings` needs no further shuffle.
    """
    order = list(tie_breaker) or [c for c in readings.columns if c not in (*KEY_COLUMNS, *KEY_PARTS)]
    window = Window.partitionBy(*KEY_PARTS).orderBy(*order)
    first = (
        with_key(readings).withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
    return first if keep_key else without_key(first)
