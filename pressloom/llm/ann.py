"""Approximate nearest neighbours by low-dimensional projections and kd-trees (operator 1).

Vectors are projected to ``DIMS`` dimensions by a Gaussian (2-stable) matrix. Rows
are dealt to blocks of a bounded size, each block with a kd-tree over its projected
points. A query takes the points of a block in order of projected distance and
verifies them on the original vectors. For a point at true distance s the squared
projected distance over s**2 has a chi-square distribution with ``DIMS`` degrees of
freedom, so once the next projected distance is so large that a point nearer than
the k-th best would have come before it with probability ``STOP``, the block is done.

Every row is indexed; queries go to every block; the best of all blocks are merged.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm.common import table

DIMS = 8  # even, so that the chi-square distribution has a closed form
STOP = 0.95
LEAF = 64
STEP = 256  # points met before the first test
BLOCK_ROWS = 16_384
SEED = 20_140


def chi2_cdf(x: float, dims: int = DIMS) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    half = x / 2
    if half > 700:
        return 1.0
    term, total = 1.0, 1.0
    for i in range(1, dims // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def projection(width: int, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, width]).standard_normal((width, dims))


class Block:
    """Vectors of a block and the kd-tree of their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray):
        points = vectors @ matrix
        order = np.arange(len(ids))
        #: per node: begin, end, first child (0: leaf), lower and upper corner of its points
        self.nodes: list[tuple[int, int, int]] = [(0, len(ids), 0)]
        low, high = [points.min(0)], [points.max(0)]
        todo = [0]
        while todo:
            n = todo.pop()
            begin, end, _ = self.nodes[n]
            if end - begin <= LEAF:
                continue
            axis, middle = int(np.argmax(high[n] - low[n])), (begin + end) // 2
            part = order[begin:end]
            order[begin:end] = part[np.argpartition(points[part, axis], middle - begin)]
            child = len(self.nodes)
            self.nodes[n] = (begin, end, child)
            for b, e in ((begin, middle), (middle, end)):
                todo.append(len(self.nodes))
                self.nodes.append((b, e, 0))
                low.append(points[order[b:e]].min(0))
                high.append(points[order[b:e]].max(0))
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.low, self.high, self.matrix = np.array(low), np.array(high), matrix

    def nearest(self, own: int, query: np.ndarray, k: int, stop: float = STOP) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, ties to the smaller id; rows of the id ``own`` are left out."""
        at = query @ self.matrix
        below = np.maximum(np.maximum(self.low - at, at - self.high), 0)
        bound = np.einsum("ij,ij->i", below, below).tolist()  # squared projected distance of each node's box
        heap = [(bound[0], 0)]
        seen_at, seen = np.empty(0), np.empty(0, np.int64)  # points met, not yet verified
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        step = STEP
        while heap or len(seen):
            met_at, met, n_met = [seen_at], [seen], 0
            while heap and n_met < step:
                _, n = heapq.heappop(heap)
                begin, end, child = self.nodes[n]
                if child:
                    heapq.heappush(heap, (bound[child], child))
                    heapq.heappush(heap, (bound[child + 1], child + 1))
                else:
                    gap = self.points[begin:end] - at
                    met_at.append(np.einsum("ij,ij->i", gap, gap))
                    met.append(np.arange(begin, end))
                    n_met += end - begin
            step *= 2  # the points of a few leaves at a time, in growing steps
            seen_at, seen = np.concatenate(met_at), np.concatenate(met)
            reach = heap[0][0] if heap else math.inf  # every point nearer than this has been met
            ready = seen_at < reach if heap else np.ones(len(seen), bool)
            if ready.any():
                rows = seen[ready]
                rows = rows[self.ids[rows] != own]
                gap = self.vectors[rows] - query
                best = np.concatenate([best, np.sqrt(np.einsum("ij,ij->i", gap, gap))])
                best_ids = np.concatenate([best_ids, self.ids[rows]])
                first = np.lexsort((best_ids, best))[:k]
                best, best_ids = best[first], best_ids[first]
                seen_at, seen = seen_at[~ready], seen[~ready]
            if len(best) == k:
                ahead = min(reach, seen_at.min() if len(seen) else math.inf)
                if ahead > 0 and (best[-1] == 0 or chi2_cdf(min(ahead, 1e300) / best[-1] ** 2) >= stop):
                    break
        return best_ids, best


def usable(vector: str):
    """Whether a vector is neither null, empty nor zero and has no null or non-finite component."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def search(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found rows of each query, nearest first, ties to the smaller id.

    Queries and rows are matched within one vector length. Rows with a null key and
    vectors that aren't usable take no part. A row with the key of the query is not
    its candidate; of several queries with one key the smallest vector is searched,
    other repeated rows are candidates each. Fewer candidates than k give all; empty
    tables give none. Score is the Euclidean distance in double precision.
    """
    valid = usable(vector) & F.col(key).isNotNull()
    data = rows.where(valid).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = queries.where(valid).groupBy(F.col(key).cast("long").alias("id"), F.size(vector).alias("width")).agg(
        F.min(F.col(vector).cast("array<double>")).alias("v"))
    n_blocks = max(1, -(-data.count() // block_rows))
    dealt = data.select(F.size("v").alias("width"), F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block"),
                        F.lit(0).alias("asks"), "id", "v")
    to_all = asked.select("width", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(1).alias("asks"), "id", "v")
    blocks = dealt.union(to_all).repartition(n_blocks, "width", "block").sortWithinPartitions("width", "block", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, vectors, tree = None, [], [], None
        for batch in batches:
            found: list[tuple[int, int, float]] = []
            flat, ends = batch.column(4).flatten().to_numpy(zero_copy_only=False), 0
            widths, numbers, asks, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            for width, block, ask, i in zip(widths.tolist(), numbers.tolist(), asks.tolist(), keys.tolist()):
                v, ends = flat[ends:ends + width], ends + width
                if (width, block) != current:
                    current, ids, vectors, tree = (width, block), [], [], None
                if not ask:
                    ids.append(i)
                    vectors.append(v)
                    continue
                if tree is None and ids:
                    tree, vectors = Block(np.array(ids), np.array(vectors), projection(width)), []
                if tree is not None:
                    found += [(i, int(a), float(b)) for a, b in zip(*tree.nearest(i, v, k))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                                              pa.array([f[2] for f in found], pa.float64())], names=["query_id", "vec_id", "score"])

    found = blocks.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every row whose vec_id is divisible by 100, among all rows."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(rows, rows.where(F.col("vec_id") % 100 == 0))


QUERIES = {"op1_ann": op1_ann}
ORACLES: dict[str, str] = {}
