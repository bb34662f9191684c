"""Nearest neighbours by collision-counting hashing, for the largest inner product.

Vectors are scaled by the largest norm and get one more coordinate that makes
them unit vectors, so the largest inner product becomes the smallest distance.
Each shard of the vectors keeps one sorted array per random projection.  A
query widens a window around its own place in every array (virtual rehashing);
a vector that has fallen into the windows of enough arrays is verified on the
original vectors.  The windows grow until a vector at the distance of the k-th
best verified one would have been counted with room to spare, or until all
vectors of the shard are verified.  A window is a range of ranks, so a shard's
collisions are counted by comparing its rank table with the windows' ends.

A query first searches the shard of its own id.  Its k-th best score there is a
bound for all other shards: they start with windows as wide as the bound asks
for, need one round, and return only what is not below it.  Vectors of different
lengths are different collections; each length has its own shards.  Shards and
query blocks are of bounded size; each pair of them is one group.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from retenta.llm.common import table, valid_vectors

K = 20
PROJECTIONS = 96
SHARD = 8192        # vectors per shard
QUERIES = 8192      # queries per block
COLLIDE = 0.7       # share of the arrays in whose windows a candidate lies
MARGIN = 0.16       # room, as a share of the distance, for the noise of the counts
GROW = 1.25         # growth of the windows per round
SEED = 42


def _matrix(cells, dim: int) -> np.ndarray:
    return np.array([np.asarray(c, dtype=np.float64) for c in cells]).reshape(-1, dim)


def search_shard(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, largest: float, k: int = K,
                 projections: int = PROJECTIONS, collide: float = COLLIDE, margin: float = MARGIN, seed: int = SEED):
    """Best k rows of one shard for each query, none below the query's bound (NaN: no bound): arrays of query id, id and inner product."""
    n, dim = x.shape
    axes = np.random.default_rng(seed).standard_normal((dim + 1, projections))
    scaled = x / largest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
    places = scaled @ axes[:dim] + rest[:, None] * axes[dim]
    order = np.argsort(places, axis=0, kind="stable")
    arrays = np.take_along_axis(places, order, axis=0).T.copy()
    ranks = np.empty((projections, n), np.uint32 if n > 60_000 else np.uint16)
    np.put_along_axis(ranks, order.T, np.arange(n, dtype=ranks.dtype)[None, :], axis=1)
    norms = np.sqrt((q * q).sum(axis=1))
    at = (q / norms[:, None]) @ axes[:dim]
    need = int(np.ceil(collide * projections))
    z = NormalDist().inv_cdf((1 + collide) / 2)

    def far(score, i):
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * score / (norms[i] * largest)))

    every = np.arange(len(q))
    reach = np.where(np.isnan(bound), 0.2, np.maximum(0.05, far(np.nan_to_num(bound), every) / (1 - margin) * (1 + 1e-9)))
    out: list[tuple] = [(np.empty(0, np.int64), np.empty(0))] * len(q)
    active = every
    while len(active):
        width = z * reach[active]
        left = np.array([np.searchsorted(arrays[p], at[active, p] - width) for p in range(projections)]).astype(ranks.dtype)
        right = np.array([np.searchsorted(arrays[p], at[active, p] + width, side="right") for p in range(projections)]).astype(ranks.dtype)
        still = []
        for j, i in enumerate(active):
            # unsigned: a rank before the window's left end becomes a large number
            counts = ((ranks - left[:, j, None]) < (right[:, j, None] - left[:, j, None])).sum(axis=0, dtype=np.uint16)
            found = np.flatnonzero(counts >= need)
            own = found[ids[found] != query_ids[i]]
            score = (x[own] * q[i]).sum(axis=1)
            if not np.isnan(bound[i]):
                own, score = own[score >= bound[i]], score[score >= bound[i]]
            best = np.lexsort((ids[own], -score))[:k]
            out[i] = ids[own[best]], score[best]
            limit = out[i][1][-1] if len(best) == k else bound[i]
            if len(found) < n and not (not np.isnan(limit) and far(limit, i) <= reach[i] * (1 - margin)):
                still.append(i)
        active = np.array(still, dtype=np.int64)
        reach[active] *= GROW
    sizes = [len(d) for d, _ in out]
    return np.repeat(query_ids, sizes), np.concatenate([*(d for d, _ in out), np.empty(0, np.int64)]), np.concatenate([*(s for _, s in out), np.empty(0)])


def nearest(vectors: DataFrame, query_rows=None, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
            shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each query row.

    query_rows is a condition on vec_id, by default ids divisible by 20; all
    rows of the query's length but those with its own id are candidates.
    Nearest first, ties to the smaller id; fewer rows where fewer candidates
    exist.  Vectors that are null, empty, zero, or hold null or non-finite
    components take no part, nor do rows without an id.  A row that repeats an
    id and its vector is one candidate.  An empty table gives an empty one;
    other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"))
    rows = table(rows.where(valid_vectors(rows) & F.col("vec_id").isNotNull()).dropDuplicates().withColumn("dim", F.size("embedding")), "vectors")
    asks = F.col("vec_id") % 20 == 0 if query_rows is None else query_rows
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    # a row for each length of vectors
    sizes = table(rows.groupBy("dim").agg((F.max(norm) * (1 + 1e-12)).alias("largest"), F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / shard)).alias("shards"),
                                          F.greatest(F.lit(1), F.ceil(F.count_if(asks) / block)).alias("blocks")), "lengths")
    # copies spread over the shards, since the id decides
    placed = rows.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), "shards").cast("int"))
    data = placed.select("dim", "shard", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block"), "vec_id", "embedding", "largest")
    # names of their own, as both sides of the groups come from one table
    asked = placed.where(asks).select(F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard"), F.pmod(F.xxhash64(F.lit(1), "vec_id"), "blocks").cast("int").alias("q_block"),
                                      F.col("shards").alias("q_shards"), F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    key = ["q_dim", "q_shard", "q_block"]

    def search(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(ask):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        dim = len(own["embedding"].iloc[0])
        found = search_shard(own["vec_id"].to_numpy(), _matrix(own["embedding"], dim), ask["query_id"].to_numpy(), _matrix(ask["query"], dim),
                             ask["bound"].to_numpy(dtype=np.float64), float(own["largest"].iloc[0]), k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    def met(asked: DataFrame) -> DataFrame:
        return data.groupBy("dim", "shard", "block").cogroup(asked.groupBy(*key)).applyInPandas(search, "query_id long, vec_id long, score double")

    first = table(met(asked.select(*key, "query_id", "query", F.lit(float("nan")).alias("bound"))), "own-shards")
    # an id that two different vectors share takes the lower of their bounds, below which neither looks
    bounds = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
    others = F.filter(F.sequence(F.lit(0), (F.col("q_shards") - 1).cast("int")), lambda i: i != F.col("q_shard"))
    rest = asked.join(bounds, "query_id", "left").withColumn("q_shard", F.explode(others)).select(
        *key, "query_id", "query", F.coalesce("bound", F.lit(float("nan"))).alias("bound"))
    near = first.unionByName(met(rest))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
