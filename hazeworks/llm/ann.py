"""Approximate nearest neighbours by stable random projections and a kd-tree.

Vectors are projected to a few dimensions by Gaussian (2-stable) coordinates: for a true distance d, the squared
projected distance is d**2 times a chi-square variable with that many degrees of freedom. A shard's projections are
indexed by a kd-tree; a query takes the points one after another by growing projected distance - a point's turn comes
when no unopened leaf's box is nearer - and their true distances are computed. It stops when the chi-square distribution
says that a vector as near as the k-th found so far would, with probability `sure`, have been projected nearer than the
next point.

Every row is indexed; nothing is fitted. Queries are a stated set against all rows: they are sent in blocks of bounded
size (`block_mb`), one block after another, and each block's copies are released before the next. The vectors stay where
they are, and each shard reports its k nearest for the merge.

Cases: vectors that are null, zero or hold null or non-finite components take no part, nor do those of another length
than the most frequent one (the smallest, if several are); rows with the query's own id are no candidates; equal
vectors are ties, and the smaller ids come first: a shard keeps the k + 1 smallest ids of equal vectors, more cannot be
returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeworks.llm.saving import saved

NEAREST = "query_id bigint, vec_id bigint, score double"


class Tree:
    """A kd-tree: each split halves the points at the median of their widest dimension, down to `leaf` points."""

    def __init__(self, points: np.ndarray, leaf: int = 32):
        self.points, self.leaves, todo = points, [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= leaf:
                self.leaves.append(rows)
                continue
            own = points[rows]
            by = np.argpartition(own[:, np.ptp(own, axis=0).argmax()], len(rows) // 2)
            todo += [rows[by[:len(rows) // 2]], rows[by[len(rows) // 2:]]]
        self.low = np.array([points[r].min(0) for r in self.leaves])
        self.high = np.array([points[r].max(0) for r in self.leaves])

    def distances(self, query: np.ndarray) -> np.ndarray:
        """Squared distance of a query from every leaf's box."""
        return (np.maximum(0, np.maximum(self.low - query, query - self.high)) ** 2).sum(1)

    def by_distance(self, query: np.ndarray, some: int) -> Iterator[tuple[np.ndarray, float]]:
        """All points by growing distance from the query, `some` at a time, each time with the first one's squared
        distance. Leaves are opened as the distance reaches their boxes."""
        box = self.distances(query)
        order = np.argsort(box, kind="stable")
        far, rows, opened, step = np.zeros(0), np.zeros(0, np.int64), 0, 1
        while opened < len(order) or len(rows):
            if opened < len(order):
                new = np.concatenate([self.leaves[i] for i in order[opened:opened + step]])
                far = np.concatenate((far, ((self.points[new] - query) ** 2).sum(1)))
                rows = np.concatenate((rows, new))
                opened += step
                step = min(2 * step, 16)
            reached = box[order[opened]] if opened < len(order) else np.inf
            ready = np.flatnonzero(far <= reached)
            ready = ready[np.argsort(far[ready], kind="stable")]
            for i in range(0, len(ready), some):
                yield rows[ready[i:i + some]], float(far[ready[i]])
            left = far > reached
            far, rows = far[left], rows[left]


def few_of_equal(ids: np.ndarray, points: np.ndarray, most: int) -> np.ndarray:
    """Rows, of equal vectors only the `most` smallest ids: no search can return more of them."""
    by = np.argsort(ids, kind="stable")
    whole = np.ascontiguousarray(points[by] + 0.0).view(np.dtype((np.void, points.itemsize * points.shape[1]))).ravel()
    _, group = np.unique(whole, return_inverse=True)
    order = np.argsort(group, kind="stable")
    group = group[order]
    new = np.concatenate(([True], np.diff(group) != 0))
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return by[order[place < most]]


def chi_square_below(x: float, half: int) -> float:
    """The chi-square distribution function for 2 * half degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, half):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total if x < 1400 else 1.0


def search(tree: Tree, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, projected: np.ndarray, own: int, k: int,
           half: int, sure: float) -> tuple[np.ndarray, np.ndarray]:
    near, names = np.zeros(0), np.zeros(0, np.int64)
    for rows, left in tree.by_distance(projected, max(k, 16)):
        # `left` is the projected distance that all of these rows and of those to come have at least
        if len(near) == k and left > 0 and (near[-1] == 0 or chi_square_below(left / near[-1], half) >= sure):
            break
        rows = rows[ids[rows] != own]
        distance = ((vectors[rows] - query) ** 2).sum(1)
        near, names = np.concatenate((near, distance)), np.concatenate((names, ids[rows]))
        best = np.lexsort((names, near))[:k]
        near, names = near[best], names[best]
    return np.sqrt(near), names


def valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            half: int = 6, sure: float = 0.9, shard_rows: int = 8192, block_mb: int = 64, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows found, by Euclidean distance.

    `queries` says which rows are queries, `half` is half the number of projected dimensions.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"),
                          queries.alias("asks")).where(valid(F.col("v")) & F.col("vec_id").isNotNull())
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("long")).alias(
        "q")).orderBy(F.desc("n"), "d").first()
    session = vectors.sparkSession
    if lengths is None:
        return session.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    d, count = lengths["d"], lengths["n"]
    rows = rows.where(F.size("v") == d)
    asking = rows.where("asks").groupBy("vec_id").agg(F.min("v").alias("v"))
    number = max(1, math.ceil((lengths["q"] or 0) * d * 8 / (block_mb * 2**20)))
    base = np.random.default_rng(seed).standard_normal((d, 2 * half))
    dealt = rows.select("vec_id", "v").repartition(max(1, math.ceil(count / shard_rows)))
    if number > 1:
        dealt, asking = saved(dealt), saved(asking)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    out = None
    for i in range(number):
        block = asking.where(F.pmod(F.xxhash64("vec_id"), F.lit(number)) == i).toArrow()
        names = block["vec_id"].to_numpy()
        asked = session.sparkContext.broadcast((names, _matrix(block["v"].combine_chunks(), d)))

        def run(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            ids, held, size = [], [], 0

            def shard() -> pa.RecordBatch:
                own, points = np.concatenate(ids), np.concatenate(held)
                some = few_of_equal(own, points, k + 1)  # one may be the query's own
                own, points = own[some], points[some]
                tree, (names, wanted) = Tree(points @ base), asked.value
                found = [search(tree, points, own, q, q @ base, n, k, half, sure)
                         for n, q in zip(names.tolist(), wanted, strict=True)]
                sizes = [len(f[0]) for f in found]
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(names, sizes)), pa.array(np.concatenate([f[1] for f in found] or [own[:0]])),
                     pa.array(np.concatenate([f[0] for f in found] or [points[:0, 0]]))], ["query_id", "vec_id", "score"])

            for batch in batches:
                if not batch.num_rows:
                    continue
                ids.append(batch.column("vec_id").to_numpy())
                held.append(_matrix(batch.column("v"), d))
                size += batch.num_rows
                if size >= 4 * shard_rows:
                    yield shard()
                    ids, held, size = [], [], 0
            if size:
                yield shard()

        merged = dealt.mapInArrow(run, NEAREST).withColumn("rank", rank).where(F.col("rank") <= k)
        if number > 1:
            merged = saved(merged)
            asked.destroy()
        out = merged if out is None else out.unionByName(merged)
    return out.select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
