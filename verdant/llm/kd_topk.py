"""Exact top-k inner products with a KD-tree per shard.

Vectors become integers, floor(64 * x).  Rows are dealt by a hash of their id
over shards of about ``SHARD_ROWS`` rows; a shard's task builds a KD-tree
(median splits of the widest dimension, tight bounding boxes) and answers its
block of queries best-first: the box with the highest upper bound of the inner
product comes next, and the search ends when that bound is under the k-th best
score so far.  A query visits its own shard first; the k-th score found there
goes along to all other shards as their starting bound.

Defined results: rows with a null id, and vectors that are null or hold null or
non-finite components, take no part; repeated rows count once; rows that share
the query's id are never its results; only vectors of the query's length are
candidates (vectors of length 0 score 0); equal scores go by the smaller id.
Scores are exact up to 2^63.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import stored

SHARD_ROWS = 16_384
QUERY_BLOCK = 8_192
LEAF = 256
SCALE = 64


def quantised(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, dim) of the rows that take part, each once."""
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) != float("inf")))
    ints = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return (df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("id"), ints.alias("v")).distinct()
            .withColumn("dim", F.size("v")))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = np.concatenate([np.asarray(c.flatten()) for c in column.chunks] or [np.empty(0, np.int64)])
    return flat.reshape(len(column), dim)


class Tree:
    """KD-tree over the rows of ``points``; boxes and splits by node."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.lo, self.hi, self.span, self.kids = [], [], [], []
        self._split(points, 0, len(points), leaf)
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _split(self, points: np.ndarray, a: int, b: int, leaf: int) -> int:
        rows = points[self.order[a:b]]
        node, lo, hi = len(self.span), rows.min(axis=0), rows.max(axis=0)
        self.lo.append(lo), self.hi.append(hi), self.span.append((a, b)), self.kids.append(None)
        if b - a > leaf and (hi > lo).any():
            axis, mid = int(np.argmax(hi - lo)), (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(rows[:, axis], mid)]
            self.kids[node] = (self._split(points, a, a + mid, leaf), self._split(points, a + mid, b, leaf))
        return node


def search(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
           bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's best k with a score of its bound or more."""
    top = max(1, int(np.abs(points).max(initial=0))) * max(1, int(np.abs(queries).max(initial=0)))
    if top * max(1, points.shape[1]) < 2 ** 53:  # then float64 sums are exact, and fast
        points, queries = points.astype(np.float64), queries.astype(np.float64)
    tree = Tree(points)
    points, ids = points[tree.order], ids[tree.order]
    upper = np.maximum(queries, 0) @ tree.hi.T + np.minimum(queries, 0) @ tree.lo.T
    found = []
    for i, q in enumerate(queries):
        ub, kth = upper[i], bounds[i]
        best_s, best_id = np.empty(0, points.dtype), np.empty(0, np.int64)
        heap = [(-ub[0], 0)]
        while heap and -heap[0][0] >= kth:
            node = heapq.heappop(heap)[1]
            if tree.kids[node]:
                for child in tree.kids[node]:
                    if ub[child] >= kth:
                        heapq.heappush(heap, (-ub[child], child))
                continue
            a, b = tree.span[node]
            scores = points[a:b] @ q
            keep = np.flatnonzero((scores >= kth) & (ids[a:b] != query_ids[i]))
            if len(keep):
                best_s = np.concatenate([best_s, scores[keep]])
                best_id = np.concatenate([best_id, ids[a:b][keep]])
                if len(best_s) >= k:
                    first = np.lexsort((best_id, -best_s))[:k]
                    best_s, best_id = best_s[first], best_id[first]
                    kth = max(kth, best_s[-1])
        found.append((np.full(len(best_id), query_ids[i]), best_id, best_s.astype(np.int64)))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _answers(rows: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    def answer(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(rows) or not len(queries):
            out = (np.empty(0, np.int64),) * 3
        else:
            dim = rows["dim"][0].as_py()
            # a bound of null: no k-th score is known yet
            bounds = [float("-inf") if x is None else x for x in queries["bound"].to_pylist()]
            out = search(_matrix(rows["v"], dim), rows["id"].to_numpy(), _matrix(queries["q_v"], dim),
                         queries["q_id"].to_numpy(), bounds, k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), out)))

    queries = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("id", "v", *keys)], "bound")
    return rows.groupBy(*keys).cogroup(queries.groupBy(*[f"q_{c}" for c in keys])).applyInArrow(
        answer, "query_id long, vec_id long, score long")


def top_k(df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` rows for each row whose id ``is_query``."""
    rows = stored(quantised(df, id_col, vec_col), "kd-rows")
    n = rows.agg(F.count("*").alias("n"), F.count_if(is_query(F.col("id"))).alias("q")).first()
    shards, blocks = max(1, math.ceil(n["n"] / shard_rows)), max(1, math.ceil(n["q"] / query_block))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    queries = rows.filter(is_query(F.col("id")))

    first = _answers(rows, queries.withColumn("bound", F.lit(None).cast("long")), ["dim", "shard"], k)
    first = stored(first, "kd-first")
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s"))
    kth = kth.select("query_id", F.when(F.col("n") >= k, F.col("s")).alias("bound"))

    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("shard"))
    spread = (queries.join(kth, queries["id"] == kth["query_id"], "left")
              .withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
              .select("id", "v", "dim", "bound", "block", F.explode(others).alias("shard")))
    copies = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rest = _answers(copies, spread, ["dim", "shard", "block"], k)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (first.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
