"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order. A document's virtual finish time is the number of words its
source has sent up to its end, divided by the source's weight; a source's second and third pass follow its first. In
one global order of finish times every source is served in proportion to its weight, and one whose passes are used up
drops out, so that the rest is shared by weight. The order is cut where the words add up to the budget.

Native DataFrame operations throughout. Sums along a queue are taken in two steps: over sections of the shuffled order
and inside each section, so that a source with most of the documents is spread over many tasks.

Cases: null text has no words; documents without words are never taken; a null source is a source of its own, the
last; repeated rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeworks.llm.saving import prefix_cut, saved, up_to

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffled(seed: str) -> Column:
    """60 bits of a digest of the document's id: the order inside a source."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = 3) -> DataFrame:
    """One row a source: its place by code point, weight, size, and target of a mix as large as all sizes together.

    A target stops at `passes` times its source's size; the excess is shared among the others by weight. In order of
    the level at which sources stop, a source stops if its level is at most what all not yet stopped would get.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))).withColumn(
        "weight", weight.cast("double"))
    most = F.col("source_size").cast("double") * passes
    by_stop = Window.orderBy(F.col("stop"), F.col("place"))
    stopped = F.coalesce(F.sum("most").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing))
    everywhere = Window.partitionBy()
    levels = ranked.withColumn("most", most).withColumn("stop", F.col("most") / F.col("weight")).withColumn(
        "level", (F.sum("source_size").over(everywhere).cast("double") - stopped) / open_weight)
    level = F.min(F.when(F.col("stop") > F.col("level"), F.struct("stop", "place", "level"))).over(everywhere)["level"]
    return levels.select("source", "place", "weight", "source_size", F.coalesce(
        F.least("most", F.col("weight") * level), F.col("most")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = 3, seed: str = "mix") -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (words) and finish (of its first copy)."""
    sizes = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    count, budget = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    sections = max(1, math.isqrt(count))
    targets = source_targets(sizes, weights, passes)
    order = ["__turn", "doc_id", "size"]
    queued = sizes.withColumn("__turn", shuffled(seed)).join(
        targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    queued = queued.withColumn("__section", (F.col("__turn") / F.lit(float(1 << 60)) * sections).cast("long"))
    sums = queued.groupBy("place", "__section").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("place").orderBy("__section").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("place", "__section", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("place", "__section").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    queued = saved(queued.join(sums, ["place", "__section"]).withColumn(
        "__sent", F.col("__before") + F.sum("size").over(inside)))
    finish = [((F.col("source_size") * k + F.col("__sent")).cast("double") / F.col("weight")) for k in range(passes)]
    queued = queued.withColumn("finish", finish[0])
    order = ["__finish", "place", *order, "__pass"]
    copies = queued.where("size > 0").select("*", F.posexplode(F.array(*finish)).alias("__pass", "__finish"))
    cut = prefix_cut(copies, order, "size", budget)
    each = [F.when(up_to(order, cut, {"__pass": F.lit(k), "__finish": f}), F.col("size")).otherwise(0)
            for k, f in enumerate(finish)]
    taken = sum(each, F.lit(0))
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "finish")


#: The same in DuckDB.
SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
ranked AS (
  SELECT *, CAST(CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight,
         CAST(source_size AS DOUBLE) * 3 AS most
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sizes GROUP BY source)),
levels AS (
  SELECT *, most / weight AS stop,
         (CAST(sum(source_size) OVER () AS DOUBLE)
          - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
targets AS (
  SELECT source, place, weight, source_size, least(most, weight * (
    SELECT first(level ORDER BY stop, place) FROM levels WHERE stop > level)) AS target
  FROM levels),
queued AS (
  SELECT s.*, t.place, t.weight, t.source_size, t.target,
         CAST('0x' || substr(md5('mix:' || s.doc_id), 1, 15) AS BIGINT) AS turn
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
sent AS (
  SELECT *, sum(size) OVER (PARTITION BY place ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) AS sent FROM queued),
copies AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, turn, doc_id, size, pass ROWS UNBOUNDED PRECEDING) AS running
  FROM (SELECT sent.*, pass, CAST(source_size * pass + sent AS DOUBLE) / weight AS finish
        FROM sent, range(3) AS passes(pass) WHERE size > 0)),
taken AS (
  SELECT doc_id, sum(size) AS taken FROM copies WHERE running <= (SELECT sum(size) FROM sizes) GROUP BY doc_id)
SELECT s.doc_id, s.source, s.size, s.source_size, s.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken,
       CAST(s.sent AS DOUBLE) / s.weight AS finish
FROM sent s LEFT JOIN taken t USING (doc_id)
"""
