"""Connected components of a graph given as links, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.llm.saving import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node reachable.

    Each round a node takes the smallest root among its neighbours', then the root of that root, until nothing
    changes. Joins have one side with a row per node, so that Spark can split a node with very many neighbours.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = saved(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    roots = saved(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")))
    while True:
        near = both.join(roots.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(
            F.min("root").alias("near"))
        step = roots.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        roots = saved(step.join(jump, "root").select("node", "was", F.least("root", "next").alias("root")))
        if not roots.where(F.col("was") != F.col("root")).limit(1).count():
            return roots.select("node", "root")
