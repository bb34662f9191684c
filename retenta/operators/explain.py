"""Global and local explanations as jobs over scored rows.

A model enters as `score(df) -> df with a score column`; explainers build the
rows to score as one DataFrame (row x permutation x step, row x grid value, row
x perturbation), score it once on the cluster and aggregate.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.expr import hash_uniform, ratio
from retenta.operators.splits import sample_rows
from retenta.plans.order import with_positions
from retenta.plans.quantiles import fit_quantiles
from retenta.plans.trees import Trees

Scorer = Callable[[DataFrame], DataFrame]


def ml_scorer(model, features: Sequence[str]) -> Scorer:
    """Scorer from a Spark ML classifier over plain feature columns."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    def score(df: DataFrame) -> DataFrame:
        vec = VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)
        out = model.setFeaturesCol("_features").transform(vec)
        return out.withColumn("score", F.get(vector_to_array("probability"), 1)).drop(
            "_features", "rawPrediction", "probability", "prediction")

    return score


def linear_attributions(df: DataFrame, ident: str, weights: dict[str, float]) -> DataFrame:
    """(id, feature, contribution): weight * (value - mean), in margin space."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in weights]).alias("m")).scalar()
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), (F.lit(w) * (F.col(c) - F.col(f"_m.{c}"))).alias("contribution"))
                      for c, w in weights.items()])
    return df.withColumn("_m", means).select(ident, F.explode(cells).alias("r")).select(ident, "r.*")


def background_rows(df: DataFrame, ident: str, features: Sequence[str], n: int = 100, seed: int = 42) -> list[dict[str, float]]:
    """A small fixed sample (n rows) to the driver: it becomes literals of the explanation plan."""
    return [r.asDict() for r in sample_rows(df.select(ident, *features), ident, n, seed).select(*features).collect()]


def shapley_attributions(df: DataFrame, ident: str, features: Sequence[str], score: Scorer, background: Sequence[dict],
                         permutations: int = 16, seed: int = 42) -> DataFrame:
    """(id, feature, contribution): sampled Shapley values of any model.

    Each draw pairs a feature order with a background row; walking along the
    order turns the background row into the explained one, and each step's
    change of score belongs to the feature just switched.  The contributions of
    a row add up to its score minus the mean score of the drawn backgrounds.
    """
    features = list(features)
    rng = random.Random(seed)
    draws = []
    for i in range(permutations):
        order = list(features)
        rng.shuffle(order)
        draws.append((i, order, background[rng.randrange(len(background))]))
    walks = []
    for i, order, back in draws:
        for step in range(len(order) + 1):
            on = set(order[:step])
            row = [(F.col(f).cast("double") if f in on else F.lit(float(back[f]))).alias(f) for f in features]
            gains = [F.struct(F.lit(order[step - 1]).alias("feature"), F.lit(1.0).alias("sign"))] if step else []
            gains += [F.struct(F.lit(order[step]).alias("feature"), F.lit(-1.0).alias("sign"))] if step < len(order) else []
            walks.append(F.struct(*row, F.array(*gains).alias("gains")))
    rows = df.select(ident, F.explode(F.array(*walks)).alias("w")).select(ident, "w.*")
    parts = score(rows).select(ident, "score", F.explode("gains").alias("g"))
    return parts.groupBy(ident, F.col("g.feature").alias("feature")).agg(
        (F.sum(F.col("g.sign") * F.col("score")) / F.lit(permutations)).alias("contribution"))


def _matrix(batch, first: int, count: int) -> np.ndarray:
    return np.column_stack([batch.column(first + i).to_numpy(zero_copy_only=False).astype(float) for i in range(count)])


def _cells(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    return df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(features)])


def _placed(df: DataFrame, features: Sequence[str], trees: Trees, *keep: str) -> DataFrame:
    """`keep` columns and _x0, _x1, ...: the trees' smallest cut that each feature's value does not exceed, else infinity.

    Rows with equal numbers go the same ways in every tree, so one of them answers for all.
    """
    cells = _cells(df, features, *keep)
    cuts, top = trees.cuts(len(features)), F.lit(float("inf"))
    names = [f"_x{i}" for i in range(len(features))]
    cells = cells.withColumns({x: F.coalesce(F.col(x), top) for x in names})
    cells = cells.withColumns({f"_cuts{x}": F.array(*map(F.lit, c.tolist())).cast("array<double>") for x, c in zip(names, cuts)})
    found = with_positions(cells, [(x, f"_cuts{x}", f"_at{x}") for x in names], max(map(len, cuts), default=0))
    return found.select(*keep, *[F.coalesce(F.get(F.col(f"_cuts{x}"), F.col(f"_at{x}")), top).alias(x) for x in names])


def _spread(cells: DataFrame) -> DataFrame:
    """Few small rows that cost much each, dealt over all tasks: a given number is not coalesced by their size."""
    spark = cells.sparkSession
    return cells.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def _explained(df: DataFrame, ident: str, features: Sequence[str], trees: Trees, answer: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(id, values): the answer for each row, computed once for all rows between the same cuts."""
    count = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                found = pa.array(list(answer(_matrix(b, 0, count))), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*b.columns, found], [*b.schema.names, "values"])

    rows = _placed(df, features, trees, ident)
    names = [f"_x{i}" for i in range(count)]
    cells = _spread(rows.select(*names).distinct())
    return rows.join(cells.mapInArrow(run, ", ".join([*(f"{x} double" for x in names), "values array<double>"])), names).select(ident, "values")


def tree_attributions(df: DataFrame, ident: str, features: Sequence[str], trees: Trees) -> DataFrame:
    """(id, feature, contribution): exact Shapley values of a tree ensemble's margin.

    A row's contributions add up to its margin less the ensemble's expectation
    over its training rows.  Values without a number go where the trees send
    them, to the right.  Features that no tree uses get 0.  Rows between the
    same cuts are explained once.
    """
    names = list(features)
    rows = _explained(df, ident, names, trees, lambda x: trees.attributions(x, len(names)))
    return rows.select(ident, F.posexplode("values").alias("_at", "contribution")).select(
        ident, F.array(*map(F.lit, names))[F.col("_at")].alias("feature"), "contribution")


def with_background(df: DataFrame, features: Sequence[str], trees: Trees) -> Trees:
    """The trees with each node's cover counted on df: attributions then start from that table's expectation.

    One count a node reaches the driver.  A side of a split that no row takes
    keeps a billionth of its parent, so every share stays above zero.
    """
    names = list(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(trees.feature), np.int64)
        for b in batches:
            if len(b):
                total += trees.visits(_matrix(b, 0, len(names)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], ["node", "n"])

    counts = _cells(df, names).mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    cover = np.zeros(len(trees.feature))
    for r in counts.collect():
        cover[r["node"]] = r["n"]
    return trees.with_cover(cover)


def tree_interactions(df: DataFrame, ident: str, features: Sequence[str], trees: Trees) -> DataFrame:
    """(id, feature1, feature2, contribution) for feature1 <= feature2 in their given order.

    A pair's contribution is its whole effect (both halves of the symmetric
    matrix), a feature's with itself what is left of its attribution; so a row's
    contributions add up to its margin less the expectation.
    """
    names = list(features)
    i, j = np.triu_indices(len(names))
    double = np.where(i == j, 1.0, 2.0)
    pairs = F.array(*[F.struct(F.lit(names[a]).alias("feature1"), F.lit(names[c]).alias("feature2")) for a, c in zip(i, j)])
    rows = _explained(df, ident, names, trees, lambda x: trees.interactions(x, len(names))[:, i, j] * double)
    return rows.select(ident, F.posexplode("values").alias("_at", "contribution")).withColumn("_p", pairs[F.col("_at")]).select(
        ident, "_p.feature1", "_p.feature2", "contribution")


def tree_interaction_strengths(df: DataFrame, features: Sequence[str], trees: Trees, top: int = 20) -> DataFrame:
    """(feature1, feature2, strength): mean absolute interaction of all rows' pairs, strongest first.

    Rows between the same cuts are counted and explained once.  Tasks add up
    their own, so a row a pair and task is all that is shuffled after that.
    """
    names = list(features)
    i, j = np.triu_indices(len(names), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(i)), 0
        for b in batches:
            if len(b):
                rows = b.column(len(names)).to_numpy()
                total += rows @ np.abs(2 * trees.interactions(_matrix(b, 0, len(names)), len(names))[:, i, j])
                n += int(rows.sum())
        yield pa.RecordBatch.from_arrays([pa.array([names[a] for a in i], pa.string()), pa.array([names[c] for c in j], pa.string()),
                                          pa.array(total), pa.array(np.full(len(i), n))], ["feature1", "feature2", "total", "n"])

    cells = _placed(df, names, trees).groupBy(*[f"_x{k}" for k in range(len(names))]).agg(F.count(F.lit(1)).alias("_n"))
    parts = _spread(cells).mapInArrow(run, "feature1 string, feature2 string, total double, n long")
    out = parts.groupBy("feature1", "feature2").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("strength"))
    return out.orderBy(F.col("strength").desc(), "feature1", "feature2").limit(top)


def global_importance(attributions: DataFrame, top: int | None = None) -> DataFrame:
    """Features by mean absolute contribution."""
    out = attributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance")).orderBy(
        F.col("importance").desc(), "feature")
    return out.limit(top) if top else out


def interaction_strengths(df: DataFrame, ident: str, features: Sequence[str], score: Scorer, background: Sequence[dict], top: int = 20) -> DataFrame:
    """(feature1, feature2, strength) for i < j: mean absolute second-order difference
    f(ij) - f(i) - f(j) + f(none) of switching two features of a background row to the explained row."""
    features = list(features)
    cells = []
    for a, b in combinations(features, 2):
        for k, back in enumerate(background):
            for on, sign in (({a, b}, 1.0), ({a}, -1.0), ({b}, -1.0), (set(), 1.0)):
                row = [(F.col(f).cast("double") if f in on else F.lit(float(back[f]))).alias(f) for f in features]
                cells.append(F.struct(*row, F.lit(a).alias("feature1"), F.lit(b).alias("feature2"), F.lit(k).alias("k"), F.lit(sign).alias("sign")))
    scored = score(df.select(ident, F.explode(F.array(*cells)).alias("c")).select(ident, "c.*"))
    second = scored.groupBy(ident, "feature1", "feature2", "k").agg(F.sum(F.col("sign") * F.col("score")).alias("d"))
    return second.groupBy("feature1", "feature2").agg(F.avg(F.abs("d")).alias("strength")).orderBy(
        F.col("strength").desc(), "feature1", "feature2").limit(top)


def partial_dependence(df: DataFrame, features: Sequence[str], score: Scorer, vary: Sequence[str] | None = None, points: int = 50) -> DataFrame:
    """(feature, grid_value, mean_score): all rows scored with one feature set to each grid value (5th to 95th percentile)."""
    features, vary = list(features), list(vary or features)
    ends = fit_quantiles(df, vary, [0.05, 0.95])
    cells = []
    for f in vary:
        for v in np.linspace(ends[f][0], ends[f][1], points):
            row = [(F.lit(float(v)) if c == f else F.col(c).cast("double")).alias(c) for c in features]
            cells.append(F.struct(*row, F.lit(f).alias("feature"), F.lit(float(v)).alias("grid_value")))
    rows = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return score(rows).groupBy("feature", "grid_value").agg(F.avg("score").alias("mean_score"))


def local_surrogate(df: DataFrame, ident: str, features: Sequence[str], score: Scorer, samples: int = 200, top: int = 10,
                    ridge: float = 1.0, seed: int = 42) -> DataFrame:
    """(id, feature, contribution): weighted ridge on perturbed copies of each row.

    Noise comes from hashes of (seed, id, draw, feature), so results repeat.
    Copies near the row weigh more (width 0.75 sqrt(features) in deviations).
    The regression sums are Spark aggregates; tasks only solve the small systems, in batches.
    """
    features = list(features)
    one = df.agg(*[F.stddev_pop(c).alias(c) for c in features]).first()
    sd = {c: float(one[c] or 1.0) for c in features}

    def normal(c: str) -> Column:
        def u(tag: str) -> Column:
            return hash_uniform(F.md5(F.concat_ws("|", F.lit(f"{seed}{tag}"), F.col(ident).cast("string"), F.col("_s").cast("string"), F.lit(c))))

        return F.sqrt(-2 * F.ln(1 - u("a"))) * F.cos(2 * np.pi * u("b"))

    rows = df.select(ident, *features).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(samples))))
    rows = rows.withColumns({f"_z_{c}": F.when(F.col("_s") == 0, F.lit(0.0)).otherwise(normal(c)) for c in features})
    rows = rows.withColumns({c: F.col(c) + F.col(f"_z_{c}") * sd[c] for c in features})
    scored = score(rows).select(ident, *[f"_z_{c}" for c in features], "score")
    width2 = float((0.75 * np.sqrt(len(features))) ** 2)
    z = [F.col(f"_z_{c}") for c in features]
    d2 = z[0] * z[0]
    for v in z[1:]:
        d2 = d2 + v * v
    d = len(features)
    w, y = F.exp(-d2 / width2), F.col("score")
    # weighted sums of 1, z, y, zz', zy: partial sums meet per id before anything is shuffled
    terms = [w, w * y, *[w * v for v in z], *[w * v * y for v in z], *[w * z[i] * z[j] for i in range(d) for j in range(d)]]
    sums = scored.groupBy(ident).agg(F.array(*[F.sum(t) for t in terms]).alias("s"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in batches:
            if g.empty:
                continue
            s = np.stack(g["s"].to_numpy())
            sw, sy, sz, szy = s[:, 0], s[:, 1], s[:, 2:2 + d], s[:, 2 + d:2 + 2 * d]
            szz = s[:, 2 + 2 * d:].reshape(-1, d, d)
            mz = sz / sw[:, None]
            left = szz - mz[:, :, None] * sz[:, None, :] + ridge * np.eye(d)
            right = szy - mz * sy[:, None]
            coef = np.linalg.solve(left, right[:, :, None])[:, :, 0]
            best = np.argsort(-np.abs(coef), axis=1, kind="stable")[:, :top]
            yield pd.DataFrame({ident: np.repeat(g[ident].to_numpy(), best.shape[1]),
                                "feature": np.array(features)[best].ravel(),
                                "contribution": np.take_along_axis(coef, best, axis=1).ravel()})

    kind = df.schema[ident].dataType.simpleString()
    return sums.mapInPandas(solve, f"{ident} {kind}, feature string, contribution double")


def ranked_array(attributions: DataFrame, ident: str, name: str, top: int | None = None) -> DataFrame:
    """Long contributions to one array per id, strongest first (ties by name); one entry per feature."""
    packed = F.array_sort(F.collect_list(F.struct((-F.abs("contribution")).alias("k"), "feature", "contribution")))
    packed = F.slice(packed, 1, top) if top else packed
    return attributions.groupBy(ident).agg(F.transform(packed, lambda s: F.struct(
        s["feature"].alias("feature"), s["contribution"].alias("contribution"))).alias(name))


def combined_explanations(scored: DataFrame, ident: str, attributions: DataFrame, surrogate: DataFrame | None = None, top: int = 10) -> DataFrame:
    """One row per id: prediction, attributions, surrogate, and top features (attributions first, surrogate as fallback)."""
    out = scored.select(ident, F.col("score").alias("prediction")).join(ranked_array(attributions, ident, "attributions"), ident, "left")
    if surrogate is not None:
        out = out.join(ranked_array(surrogate, ident, "surrogate"), ident, "left")
    else:
        out = out.withColumn("surrogate", F.lit(None).cast("array<struct<feature:string,contribution:double>>"))
    return out.withColumn("top_features", F.slice(F.coalesce("attributions", "surrogate"), 1, top))


def explainer_agreement(combined: DataFrame, tops: Sequence[int] = (3, 5, 10)) -> DataFrame:
    """Mean Jaccard overlap of the two explainers' top features at each size, and their mean as `consistency_score`."""
    def names(c: str, k: int) -> Column:
        return F.transform(F.slice(F.col(c), 1, k), lambda f: f["feature"])

    both = combined.where((F.size("attributions") > 0) & (F.size("surrogate") > 0))
    cols = [F.avg(ratio(F.size(F.array_intersect(names("attributions", k), names("surrogate", k))),
                        F.size(F.array_union(names("attributions", k), names("surrogate", k))))).alias(f"top_{k}_agreement") for k in tops]
    out = both.agg(F.count(F.lit(1)).alias("n"), *cols)
    total = F.col(f"top_{tops[0]}_agreement")
    for k in tops[1:]:
        total = total + F.col(f"top_{k}_agreement")
    return out.withColumn("consistency_score", total / len(tops))


def force_rows(attributions: DataFrame, values: DataFrame, ident: str, features: Sequence[str]) -> DataFrame:
    """(id, position, feature, value, contribution, effect): strongest first; zero counts as negative."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    long = values.select(ident, F.explode(cells).alias("r")).select(ident, "r.*")
    arr = ranked_array(attributions, ident, "a").select(ident, F.posexplode("a").alias("position", "r"))
    out = arr.select(ident, "position", "r.feature", "r.contribution").join(long, [ident, "feature"])
    return out.withColumn("effect", F.when(F.col("contribution") > 0, "positive").otherwise("negative"))


def global_explanation(df: DataFrame, ident: str, features: Sequence[str], score: Scorer, background: Sequence[dict],
                       permutations: int = 16) -> dict[str, DataFrame]:
    """Importance, interactions and partial dependence as three tables."""
    att = shapley_attributions(df, ident, features, score, background, permutations)
    return {"importance": global_importance(att),
            "interactions": interaction_strengths(df, ident, features, score, background),
            "partial_dependence": partial_dependence(df, features, score)}
