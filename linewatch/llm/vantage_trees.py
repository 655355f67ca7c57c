"""Nearest neighbours by inner product from vantage-point trees, one for each shard.

A vector of norm n gets one more component, sqrt(m^2 - n^2) with m the largest norm, and a query
a 0 there; the Euclidean distance, for which triangles hold, then orders as the inner product does.
Every node of a tree splits its vectors at the median distance to a vantage point. Distances of a
query to the vantage points on the way to a leaf bound its distance to all vectors of the leaf from
below. Leaves are visited by rising bound until `factor` times the bound passes the distance of
the worst neighbour kept: factor 1 is exact search, larger ones stop sooner.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linewatch.llm.common import prepare, staged, table

NEIGHBOURS = 20
#: Above 1 for fewer visits; measured recall is in the README.
FACTOR = 1.1
#: Vectors of a shard and queries of a block: what one task holds.
SHARD, BLOCK = 8192, 4096
LEAF = 256
#: Bounds are lowered by this share, against rounding.
SLACK = 1e-9


class Tree:
    """A vantage-point tree in arrays; leaves are the rows of `leaf` in the order of `rows`."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.rows = points, np.arange(len(points))
        self.vantage, self.radius, self.leaves = [], [], []  # leaves: (from, to, path)
        todo = [(0, len(points), ())]
        while todo:
            a, b, path = todo.pop()
            if b - a <= leaf:
                self.leaves.append((a, b, path))
                continue
            rows = self.rows[a:b]
            v = rows[(b - a) // 2]
            d = distance(points[v: v + 1], points[rows])[0]
            half = (b - a) // 2
            by = np.argpartition(d, half)
            self.rows[a:b] = rows[by]
            node = len(self.vantage)
            self.vantage.append(v)
            # both sides keep their own reach, so equal distances may lie on either
            self.radius.append((d[by[:half]].max(), d[by[half:]].min()))
            todo += [(a, a + half, (*path, (node, 0))), (a + half, b, (*path, (node, 1)))]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries, leaves): no vector of the leaf is nearer than this."""
        out = np.zeros((len(queries), len(self.leaves)))
        if not self.vantage:
            return out
        d = distance(queries, self.points[self.vantage])
        for k, (_, _, path) in enumerate(self.leaves):
            for node, side in path:
                near, far = self.radius[node]
                gap = d[:, node] - near if side == 0 else far - d[:, node]
                np.maximum(out[:, k], gap, out=out[:, k])
        return out


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, summed in the order of components whatever the block."""
    out = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        out += a[:, k][:, None] * b[:, k][None]
    return out


def search(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
           norm: float, k: int = NEIGHBOURS, factor: float = FACTOR, leaf: int = LEAF
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of up to k neighbours of each query other than itself."""
    size = (vectors * vectors).sum(1)
    lift = np.sqrt(np.maximum(norm * norm - size, 0))
    tree = Tree(np.column_stack([vectors, lift]), leaf)
    q = np.column_stack([queries, np.zeros(len(queries))])
    bound = tree.bounds(q)
    order = np.argsort(bound, axis=1, kind="stable")
    n = len(queries)
    score, name = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
    own = (queries * queries).sum(1)
    alive = np.arange(n)
    for turn in range(len(tree.leaves)):
        # distance^2 to a vector = own + norm^2 - 2 * score
        worst = np.sqrt(np.maximum(own[alive] + norm * norm - 2 * score[alive, -1], 0))
        low = bound[alive, order[alive, turn]] * (1 - SLACK) - SLACK
        alive = alive[low * factor <= worst]
        if not len(alive):
            break
        to = order[alive, turn]
        for leaf_ in np.unique(to):
            a, b, _ = tree.leaves[leaf_]
            rows = tree.rows[a:b]
            every = alive[to == leaf_]
            for i in range(0, len(every), 512):
                who = every[i: i + 512]
                got = inner(queries[who], vectors[rows])
                got[ids[rows][None] == query_ids[who][:, None]] = -np.inf
                s = np.concatenate([score[who], got], axis=1)
                m = np.concatenate([name[who], np.broadcast_to(ids[rows], got.shape)], axis=1)
                by = np.lexsort((m, -s), axis=1)[:, :k]
                score[who] = np.take_along_axis(s, by, 1)
                name[who] = np.take_along_axis(m, by, 1)
    hit = np.isfinite(score)
    return np.nonzero(hit)[0], name[hit], score[hit]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of rows that take part, v in double precision."""
    v = F.transform(vector, lambda x: x.cast("double"))
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("id"), v.alias("v")).where(
        fine & F.exists("v", lambda x: x != 0))


def nearest(
    vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int = NEIGHBOURS,
    factor: float = FACTOR, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest of vectors found for each query, by
    inner product; ties go to the smaller id, and a vector is not a neighbour of its own id.

    Rows whose vector or id is null, and vectors that are zero or hold a null, NaN or infinite
    component take no part; nor do vectors of another length than the query's. Repeated rows are
    repeated neighbours; repeated rows of a query are one query, of several vectors of one query id
    the first in order counts. Shards and query blocks are of bounded size and spread by hash, so equal
    vectors do not meet in one task; each task has one of each and gives k rows a query.
    """
    prepare(vectors.sparkSession)
    base = staged(usable(vectors, key, vector).withColumn("dim", F.size("v")), "vectors")
    # rows of one query id would share its ranks
    asked = staged(usable(queries, key, vector).groupBy("id").agg(F.min("v").alias("v")).withColumn(
        "dim", F.size("v")), "queries")
    norms = base.groupBy("dim").agg(F.max(F.sqrt(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x * x))).alias("norm"), F.count(F.lit(1)).alias("n"))
    blocks = asked.groupBy("dim").agg(F.count(F.lit(1)).alias("m"))
    # one row for each length of vectors
    sizes = staged(norms.join(blocks, "dim").select(
        "dim", "norm", F.ceil(F.col("n") / shard).cast("int").alias("shards"),
        F.ceil(F.col("m") / block).cast("int").alias("blocks")), "sizes")

    def spread(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(own + "s")).cast("int").alias(own)
        return df.join(F.broadcast(sizes), "dim").select(
            "id", "v", "dim", (F.col("norm") + 0).alias("norm"), mine,
            F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1)).alias(other))

    kind = "query_id long, vec_id long, score double"

    def matrix(t: pa.Table) -> np.ndarray:
        v = t["v"].combine_chunks()
        return v.flatten().to_numpy().reshape(t.num_rows, -1).astype(float)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        names = left["id"].to_numpy()
        by = np.argsort(names, kind="stable")
        asked_ids = right["id"].to_numpy()
        row, name, score = search(matrix(left)[by], names[by], matrix(right), asked_ids,
                                  left["norm"][0].as_py(), k, factor)
        return pa.table({"query_id": asked_ids[row], "vec_id": name, "score": score})

    cells = ["dim", "shard", "block"]
    found = spread(base, "shard", "block").groupBy(*cells).cogroup(
        spread(asked, "block", "shard").groupBy(*cells)).applyInArrow(run, kind)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op3_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding")
