"""Customer clustering, cluster quality and segment profiles."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from retenta.functions.expr import ratio
from retenta.operators.quality import value_counts
from retenta.operators.transform import apply_numeric, fit_numeric
from retenta.plans.quantiles import quantiles
from retenta.session import settle


def standardised(df: DataFrame, ident: str, cols: Sequence[str]) -> DataFrame:
    """Id and median-filled, standardised columns as a vector, settled once for the many fits that follow.

    No more tasks than cores: each of a fit's many short jobs sends the driver a few kilobytes a task.
    """
    ready = apply_numeric(df, fit_numeric(df, cols, winsor=False))
    vec = VectorAssembler(inputCols=list(cols), outputCol="features").transform(ready)
    return settle(vec.select(ident, *cols, "features"), "standardised").coalesce(max(2, df.sparkSession.sparkContext.defaultParallelism))


def fit_kmeans(vec: DataFrame, k: int, restarts: int = 10, seed: int = 42, parallelism: int = 4):
    """The cheapest of several seeded runs (the first of equal ones); runs wait on the cluster side by side."""
    with ThreadPoolExecutor(parallelism) as pool:
        models = list(pool.map(lambda i: KMeans(k=k, seed=seed + i, maxIter=100, tol=1e-4).fit(vec), range(restarts)))
    return min(models, key=lambda m: m.summary.trainingCost)


def kmeans_segments(df: DataFrame, ident: str, cols: Sequence[str], k: int = 4, restarts: int = 10, seed: int = 42) -> DataFrame:
    vec = standardised(df, ident, cols)
    return fit_kmeans(vec, k, restarts, seed).transform(vec).select(ident, F.col("prediction").alias("segment"))


def choose_k(df: DataFrame, ident: str, cols: Sequence[str], max_clusters: int = 10, restarts: int = 10, seed: int = 42,
             method: str = "kmeans", micro: int = 200) -> DataFrame:
    """Quality per k = 2..max: silhouette (squared Euclidean), Calinski-Harabasz, Davies-Bouldin, inertia; `best` marks the top silhouette.

    method is kmeans, or hierarchical: one dendrogram answers every k, inertia is then 0.
    """
    if method not in ("kmeans", "hierarchical"):
        raise ValueError("method must be kmeans or hierarchical")
    vec = standardised(df, ident, cols)
    n = vec.count()
    if n < 10:
        raise ValueError("need at least 10 rows for clustering")
    ks = range(2, min(max_clusters + 1, n // 2))
    if method == "hierarchical":
        tree = Dendrogram.fit(vec, micro, seed)
        placed = settle(tree.place(vec), "micro-clusters")
        labelled = [(k, tree.cut(placed, k).withColumnRenamed("segment", "prediction"), 0.0) for k in ks if k <= tree.leaves]
    else:
        models = [(k, fit_kmeans(vec, k, restarts, seed)) for k in ks]
        labelled = [(k, m.transform(vec), m.summary.trainingCost) for k, m in models]
    parts = []
    for k, rows, inertia in labelled:
        q = cluster_quality(rows.withColumnRenamed("prediction", "segment"), cols, "segment")
        parts.append(q.select(F.lit(k).alias("n_clusters"), F.lit(ClusteringEvaluator().evaluate(rows)).alias("silhouette"), "calinski_harabasz",
                              "davies_bouldin", F.lit(inertia).alias("inertia")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = settle(out, "cluster-choice")
    return out.withColumn("best", F.col("n_clusters") == out.agg(F.max_by("n_clusters", F.struct(F.col("silhouette"), -F.col("n_clusters")))).scalar())


def cluster_quality(df: DataFrame, cols: Sequence[str], segment: str) -> DataFrame:
    """One row: n_clusters, Calinski-Harabasz and Davies-Bouldin from per-cluster sums.

    Rows meet only aggregates and the table of centroids; the pairing of
    centroids is clusters x clusters.
    """
    cols = list(cols)
    cent = df.groupBy(segment).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_m_{c}") for c in cols])
    d2 = sum(((F.col(c) - F.col(f"_m_{c}")) * (F.col(c) - F.col(f"_m_{c}")) for c in cols[1:]),
             (F.col(cols[0]) - F.col(f"_m_{cols[0]}")) * (F.col(cols[0]) - F.col(f"_m_{cols[0]}")))
    within = df.join(cent, segment).groupBy(segment).agg(F.sum(d2).alias("_w"), F.avg(F.sqrt(d2)).alias("_s"))
    c = cent.join(within, segment)
    whole = W.partitionBy()  # one row per cluster
    total = F.sum("_n").over(whole)
    off = sum((F.pow(F.col(f"_m_{x}") - F.sum(F.col("_n") * F.col(f"_m_{x}")).over(whole) / total, 2) for x in cols), F.lit(0.0))
    spread = c.select((F.col("_n") * off).alias("_b"), "_w", "_n").agg(
        F.sum("_b").alias("b"), F.sum("_w").alias("w"), F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_clusters"))
    a, b = c.alias("a"), c.alias("b")
    dist = F.sqrt(sum((F.pow(F.col(f"a._m_{x}") - F.col(f"b._m_{x}"), 2) for x in cols), F.lit(0.0)))
    worst = a.join(b, F.col(f"a.{segment}") != F.col(f"b.{segment}")).groupBy(F.col(f"a.{segment}")).agg(
        F.max((F.col("a._s") + F.col("b._s")) / dist).alias("r"))
    t = spread.withColumn("j", F.lit(1)).join(worst.agg(F.avg("r").alias("davies_bouldin")).withColumn("j", F.lit(1)), "j")
    k = F.col("n_clusters")
    return t.select(k, ratio(F.col("b") * (F.col("n") - k), F.col("w") * (k - 1)).alias("calinski_harabasz"), "davies_bouldin")


def ward_linkage(centres: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ward's merges of weighted points, lowest first: rows (left, right, height, size); merge i makes group n + i.

    A chain of nearest neighbours is followed until two groups are nearest to
    each other, which then merge for good: one distance row per step, so
    the square of the points in time and the points alone in memory.
    height is the square root of twice the growth of the squared error.
    """
    c, w = np.array(centres, np.float64), np.array(sizes, np.float64)
    n = len(c)
    alive, group = np.ones(n, bool), np.arange(n)
    chain: list[int] = []
    merges = []
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            a = chain[-1]
            cost = 2 * w * w[a] / (w + w[a]) * ((c - c[a]) ** 2).sum(axis=1)
            cost[~alive] = np.inf
            cost[a] = np.inf
            b = int(cost.argmin())
            if len(chain) > 1 and cost[chain[-2]] <= cost[b]:
                b = chain[-2]  # also where another is as near, or the chain would not end
                break
            chain.append(b)
        chain = chain[:-2]
        merges.append((a, b, np.sqrt(cost[b])))
        c[a] = (w[a] * c[a] + w[b] * c[b]) / (w[a] + w[b])
        w[a] += w[b]
        alive[b] = False
    # the chain finds merges in no order of height; a slot's group is the last one it merged into
    order = sorted(range(n - 1), key=lambda i: (merges[i][2], i))
    out, weight, parent = np.zeros((n - 1, 4)), list(np.array(sizes, np.float64)), list(range(n))

    def slot(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for step, i in enumerate(order):
        a, b = slot(merges[i][0]), slot(merges[i][1])
        left, right = sorted((int(group[a]), int(group[b])))
        weight.append(weight[left] + weight[right])
        out[step] = left, right, merges[i][2], weight[-1]
        parent[b] = a
        group[a] = n + step
    return out


def cut_linkage(linkage: np.ndarray, k: int) -> list[int]:
    """Group 0..k-1 of every leaf when k groups are left, numbered by their smallest leaf."""
    n = len(linkage) + 1
    top = list(range(2 * n - 1))
    for i, (a, b, _, _) in enumerate(linkage[:n - k]):
        top[int(a)] = top[int(b)] = n + i
    found, names = [], {}
    for leaf in range(n):
        at = leaf
        while top[at] != at:
            at = top[at]
        found.append(names.setdefault(at, len(names)))
    return found


class Dendrogram:
    """Ward clustering in two stages: k-means into micro clusters on the cluster, the linkage of their centroids here.

    The pairwise stage sees only `micro` centroids whatever the row count; with
    no more distinct rows than that it is Ward clustering of the rows.
    """

    def __init__(self, model, linkage: np.ndarray) -> None:
        self.model, self.linkage, self.leaves = model, linkage, len(linkage) + 1

    @classmethod
    def fit(cls, vec: DataFrame, micro: int = 200, seed: int = 42) -> "Dendrogram":
        model = KMeans(k=micro, seed=seed, maxIter=50, predictionCol="_micro").fit(vec)
        centres = np.array(model.clusterCenters())  # fewer than asked for where rows repeat; the sizes' list is as long as asked for
        return cls(model, ward_linkage(centres, np.maximum(np.array(model.summary.clusterSizes)[:len(centres)], 1)))

    def place(self, vec: DataFrame) -> DataFrame:
        """vec with the number of each row's micro cluster."""
        return self.model.transform(vec)

    def cut(self, placed: DataFrame, k: int) -> DataFrame:
        """Placed rows with their segment of k."""
        labels = F.array(*[F.lit(v) for v in cut_linkage(self.linkage, min(k, self.leaves))])
        return placed.withColumn("segment", F.get(labels, F.col("_micro"))).drop("_micro")

    def table(self, spark: SparkSession) -> DataFrame:
        """(step, left, right, height, size): merges from the lowest, leaves are micro clusters, merge i makes group leaves + i."""
        rows = [(i, int(a), int(b), float(h), float(s)) for i, (a, b, h, s) in enumerate(self.linkage)]
        return spark.createDataFrame(rows, "step int, left int, right int, height double, size double")


def hierarchical_segments(df: DataFrame, ident: str, cols: Sequence[str], k: int | None = 4, micro: int = 200, seed: int = 42,
                          max_clusters: int = 10) -> DataFrame:
    """(id, segment) by Ward's dendrogram of micro clusters, cut at k groups; k None takes the best silhouette of 2..max_clusters."""
    vec = standardised(df, ident, cols)
    tree = Dendrogram.fit(vec, micro, seed)
    placed = tree.place(vec)
    if k is None:
        placed = settle(placed, "micro-clusters")
        score = {j: ClusteringEvaluator().evaluate(tree.cut(placed, j).withColumnRenamed("segment", "prediction"))
                 for j in range(2, min(max_clusters, tree.leaves) + 1)}
        k = min(score, key=lambda j: (-score[j], j))
    return tree.cut(placed, k).select(ident, "segment")


def segment_sizes(df: DataFrame, segment: str, label: str | None = None) -> DataFrame:
    """Rows, share and label rate per segment."""
    total = df.agg(F.count(F.lit(1))).scalar()
    rate = F.avg(F.col(label).cast("double")) if label else F.lit(0.0)
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("size"), (F.max(rate) if not label else rate).alias("churn_rate")).withColumn(
        "size_pct", F.col("size") * 100.0 / total)


def segment_numeric_profile(df: DataFrame, segment: str, cols: Sequence[str], top: int = 5) -> DataFrame:
    """mean, median, std per segment and column; relative difference from the overall mean and its rank (top 5 flagged)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])
    long = df.where(F.col(segment).isNotNull()).select(segment, F.explode(cells).alias("r")).select(segment, "r.*")
    per = long.groupBy(segment, "column").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                                              F.count("x").alias("n"), F.sum("x").alias("s"))
    overall = per.groupBy("column").agg(ratio(F.sum("s"), F.sum("n")).alias("overall_mean"))
    med = quantiles(df, cols, [0.5], [segment]).select(segment, "column", F.col("value").alias("median"))
    t = per.join(overall, "column").join(med, [segment, "column"], "left")
    diff = ratio(F.abs(F.col("mean") - F.col("overall_mean")), F.abs(F.col("overall_mean")))
    order = W.partitionBy(segment).orderBy(F.col("relative_difference").desc_nulls_last(), "column")  # one row per column
    t = t.withColumn("relative_difference", diff).withColumn("rank", F.row_number().over(order))
    is_top = (F.col("rank") <= top) & F.col("relative_difference").isNotNull()
    return t.select(segment, "column", "mean", "median", "std", "relative_difference", is_top.alias("is_top_feature"))


def segment_categorical_profile(df: DataFrame, segment: str, cols: Sequence[str]) -> DataFrame:
    """Most frequent value per segment and column and its share of all the segment's rows."""
    counts = value_counts(df.where(F.col(segment).isNotNull()), cols, [segment])
    best = counts.groupBy(segment, "column").agg(F.max("n").alias("n"))
    mode = counts.join(best, [segment, "column", "n"]).groupBy(segment, "column", "n").agg(F.min("value").alias("mode"))
    sizes = df.groupBy(segment).agg(F.count(F.lit(1)).alias("size"))
    return mode.join(sizes, segment).select(segment, "column", "mode", (F.col("n") / F.col("size")).alias("mode_frequency"))
