"""Exact k largest inner products with KD-trees per shard.

Vectors are dealt to shards by a hash of their id. A task holds one shard and one block
of queries: it splits the shard at medians of the widest side down to small leaves with tight
bounding boxes, and serves each query best first: the largest inner product a box allows decides
what is opened next, and whatever cannot reach the k-th best so far stays closed.
A first wave gives every block of queries one shard; its k-th scores then start all
other shards, which therefore close most boxes sooner.

Tasks hold ``shard_rows`` vectors and ``block_rows`` queries at most (on average), whatever the table's size.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, as
do rows without id; scores compare vectors of equal length only; rows equal in id and vector count once;
rows that share an id are one query's own and never its neighbours; ties go to the smaller id; with fewer
than k candidates all are returned; an empty table gives an empty result; other columns are ignored.
Scores are exact up to 2^63.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import kept, ship

SHARD_ROWS, BLOCK_ROWS, LEAF = 8192, 512, 128
HIT = "query_id bigint, vec_id bigint, score bigint"


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """vec_id and v: floor(scale * x) of every vector that takes part."""
    v = F.col(vector).cast("array<double>")
    return (
        rows.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull())
        .select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
        .where((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull()))
        .where(F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .select(
            "vec_id",
            F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"),
            F.size("v").alias("dims"),
        )
    )


@dataclass
class Tree:
    """Nodes as arrays: box, children (-1: leaf), rows start..end, smallest id."""

    ids: np.ndarray
    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray
    span: np.ndarray
    least: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray) -> Tree:
        order = np.arange(len(ids))
        low, high, child, span, least = [], [], [], [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            node = len(low)
            if parent >= 0:
                child[parent][side] = node
            rows = points[order[start:end]]
            low.append(rows.min(axis=0))
            high.append(rows.max(axis=0))
            child.append([-1, -1])
            span.append((start, end))
            least.append(int(ids[order[start:end]].min()))
            wide = int(np.argmax(high[-1] - low[-1]))
            if end - start <= LEAF or high[-1][wide] == low[-1][wide]:
                continue
            middle = (start + end) // 2
            order[start:end] = order[start:end][np.argpartition(rows[:, wide], middle - start)]
            todo += [(start, middle, node, 0), (middle, end, node, 1)]
        return cls(ids[order], points[order], np.array(low), np.array(high), np.array(child), np.array(span), np.array(least))

    def best(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best that reach ``floor``, best first."""
        scores, ids = np.zeros(0, self.points.dtype), np.zeros(0, np.int64)
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            full = len(ids) == k
            kth = max(floor, scores[-1]) if full else floor
            if -bound < kth:
                break
            if full and -bound == scores[-1] and self.least[node] > ids[-1]:
                continue
            if self.child[node][0] >= 0:
                for at in self.child[node]:
                    if bounds[at] >= kth:
                        heapq.heappush(queue, (-bounds[at], int(at)))
                continue
            start, end = self.span[node]
            here = self.points[start:end] @ query
            take = (here >= kth) & (self.ids[start:end] != query_id)
            scores = np.concatenate((scores, here[take]))
            ids = np.concatenate((ids, self.ids[start:end][take]))
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
        return scores, ids


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy()
    return flat.reshape(rows, -1)


def searched(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Candidates of each query from the points that share its (shard, block)."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            p, q = _matrix(left.column("v"), left.num_rows), _matrix(right.column("v"), right.num_rows)
            peak = float(np.abs(p).max()) * float(np.abs(q).max()) * p.shape[1]
            if peak < 2**53:  # Then doubles hold every sum exactly, and are faster.
                p, q = p.astype(np.float64), q.astype(np.float64)
            tree = Tree.build(left.column("vec_id").to_numpy(), p)
            bounds = np.maximum(q, 0) @ tree.high.T + np.minimum(q, 0) @ tree.low.T
            floors = right.column("kth").to_pylist()
            for i, query_id in enumerate(right.column("query_id").to_pylist()):
                floor = -np.inf if floors[i] is None else floors[i]
                scores, ids = tree.best(query_id, q[i], bounds[i], k, floor)
                out.append((np.full(len(ids), query_id), ids, scores.astype(np.int64)))
        columns = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (list(zip(*out, strict=True)) or [()] * 3)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    ship(points.sparkSession)
    # Both sides come from one table; new names keep their columns apart.
    queries = queries.toDF(*[f"{c}_" for c in queries.columns]).toDF(*queries.columns)
    keys = ["shard", "block", "dims"]
    return points.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, HIT)


def top_k(
    rows: DataFrame,
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each id divisible by ``every``."""
    vectors = kept(whole_vectors(rows, vec_id, vector, scale).distinct(), "nearest-vectors")
    asked = vectors.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    counts = vectors.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    shards, blocks = -(-counts["n"] // shard_rows) or 1, -(-counts["q"] // block_rows) or 1
    deal = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    points = vectors.select("*", deal("vec_id", shards).alias("shard"))
    asked = asked.select("*", deal("query_id", blocks).alias("block"))
    home = F.pmod("block", F.lit(shards))
    copies = points.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    near = kept(
        searched(
            copies.where(F.col("shard") == home),
            asked.select("*", home.cast("int").alias("shard"), F.lit(None).cast("long").alias("kth")),
            k,
        ),
        "nearest-first",
    )
    kth = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    known = asked.join(kth.where(F.col("n") == k).select("query_id", "kth"), "query_id", "left")
    others = known.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    far = searched(copies.where(F.col("shard") != home), others.where(F.col("shard") != home), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.union(far).select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)
