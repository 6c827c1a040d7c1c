"""Cutting lineage, and finding where a global order crosses a budget."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F


def saved(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the folder that the cluster shares (spark.checkpoint.dir).

    In local mode without that setting, as in tests, a temporary folder serves.
    """
    context = df.sparkSession.sparkContext
    if not df.sparkSession.conf.get("spark.checkpoint.dir", None) and not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-"))
    return df.checkpoint()


def prefix_cut(entries: DataFrame, order: list[str], amount: str, budget: int) -> Row | None:
    """The last row, in a global order, up to which `amount` adds up to `budget` at most; None if the first is more.

    Rows are dealt into ranges of the order and kept. The sums of all ranges (one row a range) tell the range that
    crosses the budget; only that one is summed row by row.
    """
    spark = entries.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = saved(entries.select(*order, amount).repartitionByRange(ranges, *order)
                 .withColumn("__range", F.spark_partition_id()))
    before, crossed = 0, None
    sums = kept.groupBy("__range").agg(F.sum(amount).alias("amount")).collect()
    for row in sorted(sums, key=lambda r: r["__range"]):
        crossed = row["__range"]
        if before + row["amount"] > budget:
            break
        before += row["amount"]
    if crossed is None:
        return None
    running = F.sum(amount).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    inside = kept.where(F.col("__range") == crossed).withColumn("__sum", running).where(F.col("__sum") <= budget - before)
    key = F.max(F.struct(*order)).alias("key")
    for part in (inside, kept.where(F.col("__range") < crossed)):
        found = part.agg(key).first()["key"]
        if found is not None:
            return found
    return None


def up_to(order: list[str], cut: Row | None, values: dict[str, Column] | None = None) -> Column:
    """Whether a row, with some values in place of its columns, comes before the cut or is it."""
    if cut is None:
        return F.lit(False)
    here = F.struct(*[(values or {}).get(c, F.col(c)).alias(c) for c in order])
    return here <= F.struct(*[F.lit(cut[c]).alias(c) for c in order])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster shares; in local mode without such a setting, a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='corpus-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def let_workers_import(spark: SparkSession) -> None:
    """Adds the folder of this package to the Python path of workers. It helps where they share a file system with the
    driver, as in local mode; on a cluster, ship the package with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])
