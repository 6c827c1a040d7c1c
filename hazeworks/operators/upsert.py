"""Insert-if-absent on (city, measurement time), as joins against the stored readings.

A batch from `clean` has unique keys; with `keep_key` it is partitioned for the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.operators.keys import KEY_PARTS, key_columns, with_key, without_key


def _stored_keys(stored: DataFrame) -> DataFrame:
    # Distinct before the join: partial aggregation shrinks a key that was stored many times.
    parts = key_columns(stored)
    return stored.select(*[part.alias(name) for name, part in parts.items()]).distinct()


def _match(batch: DataFrame, stored: DataFrame, how: str) -> DataFrame:
    matched = with_key(batch).join(_stored_keys(stored), KEY_PARTS, how)
    return without_key(matched.select(*batch.columns))


def new_readings(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of the batch whose key is not stored yet: what an insert adds."""
    return _match(batch, stored, "left_anti")


def known_readings(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of the batch whose key is stored already: what an insert skips."""
    return _match(batch, stored, "left_semi")


def load_counts(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Inserted and skipped row counts of a batch, in one pass over both sides.

    Of readings with one key in the batch, one is inserted; the counts per key go into the join.
    """
    stored_keys = _stored_keys(stored).withColumn("_known", F.lit(True))
    keys = with_key(batch).groupBy(*KEY_PARTS).agg(F.count("*").alias("_rows"))
    inserted = F.count_if(F.col("_known").isNull())
    rows = F.coalesce(F.sum("_rows"), F.lit(0))
    return keys.join(stored_keys, KEY_PARTS, "left").agg(
        rows.alias("batch_rows"), inserted.alias("inserted_rows"), (rows - inserted).alias("skipped_rows"))


def history_union(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored readings and a batch on top of each other, columns matched by name."""
    return stored.unionByName(without_key(batch))
