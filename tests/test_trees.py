"""Second-order boosting and exact tree attributions against plain computations."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from retenta.operators import boosting, explain, models
from retenta.plans.trees import Trees, from_ml


def some_rows(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    y = (x[:, 0] * x[:, 1] + (x[:, 2] > 0.3) + rng.normal(size=n) * 0.3 > 0.4).astype(float)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, `d.e` double, label double")


NAMES = ["a", "b", "c", "d.e"]


def game(t, x, on):
    """The trees' answer when only the features in `on` are known."""
    def at(node):
        f = t.feature[node]
        if f < 0:
            return t.value[node]
        if f in on:
            return at(t.left[node] if x[f] <= t.threshold[node] else t.right[node])
        return sum(at(c) * t.cover[c] for c in (t.left[node], t.right[node])) / t.cover[node]

    return t.base + sum(at(r) for r in t.roots)


def brute(t, x, k):
    phi, pairs = np.zeros(k), np.zeros((k, k))
    value = {s: game(t, x, set(s)) for n in range(k + 1) for s in itertools.combinations(range(k), n)}
    for s, v in value.items():
        for i in set(range(k)) - set(s):
            phi[i] += math.factorial(len(s)) * math.factorial(k - len(s) - 1) / math.factorial(k) * (value[tuple(sorted((*s, i)))] - v)
        for i, j in itertools.combinations(sorted(set(range(k)) - set(s)), 2):
            w = math.factorial(len(s)) * math.factorial(k - len(s) - 2) / math.factorial(k - 1) / 2
            d = value[tuple(sorted((*s, i, j)))] - value[tuple(sorted((*s, i)))] - value[tuple(sorted((*s, j)))] + v
            pairs[i, j] += w * d
            pairs[j, i] += w * d
    pairs[np.arange(k), np.arange(k)] = phi - pairs.sum(axis=1)
    return phi, pairs


@pytest.fixture(scope="module")
def fitted(spark):
    x, y = some_rows()
    df = frame(spark, x, y)
    return df, x, y, boosting.boost(df, "id", NAMES, trees=12, depth=4, bins=32)


def test_attributions_equal_all_subsets(fitted):
    df, x, _, model = fitted
    t, k = model.trees, 4
    rows = np.vstack([x[:12], [[np.nan, 0.1, np.nan, 2.0]]])
    phi, pairs = t.attributions(rows, k), t.interactions(rows, k)
    assert np.allclose(t.expectation, game(t, rows[0], set()))
    for r, p, q in zip(rows, phi, pairs):
        plain, both = brute(t, r, k)
        assert np.allclose(p, plain) and np.allclose(q, both)
    assert np.allclose(phi.sum(axis=1), t.margin(rows) - t.expectation) and np.allclose(pairs.sum(axis=2), phi)


def test_attribution_tables_add_up(fitted):
    df, x, _, model = fitted
    margin = {r["id"]: r["margin"] for r in model.score(df, ["id"]).collect()}
    assert np.allclose([margin[i] for i in range(len(x))], model.trees.margin(x))
    sums = explain.tree_attributions(df, "id", NAMES, model.trees).groupBy("id").agg(F.sum("contribution").alias("s"), F.count("*").alias("n")).collect()
    both = explain.tree_interactions(df, "id", NAMES, model.trees).groupBy("id").agg(F.sum("contribution").alias("s"), F.count("*").alias("n")).collect()
    for rows, n in ((sums, 4), (both, 10)):
        assert len(rows) == len(x) and all(r["n"] == n and abs(r["s"] + model.trees.expectation - margin[r["id"]]) < 1e-9 for r in rows)
    top = explain.tree_interaction_strengths(df, NAMES, model.trees).collect()
    assert len(top) == 6 and (top[0]["feature1"], top[0]["feature2"]) == ("a", "b")
    assert abs(top[0]["strength"] - 2 * np.abs(model.trees.interactions(x, 4)[:, 0, 1]).mean()) < 1e-9


def test_attributions_of_spark_models(spark, fitted):
    df, x, _, _ = fitted
    vec = models.assemble(df.withColumnRenamed("d.e", "d"), ["a", "b", "c", "d"], ["id", "label"])
    for est, link in ((models.forest(numTrees=5, maxDepth=4), lambda m: m), (models.boosted(weighted=False, maxIter=4, maxDepth=3), lambda m: 1 / (1 + np.exp(-m)))):
        model = est.fit(vec)
        t = from_ml(model, spark)
        scores = [r["score"] for r in models.score_with(model, vec, ["id"]).orderBy("id").collect()]
        assert np.allclose(link(t.margin(x)), scores)
        phi, _ = brute(t, x[0], 4)
        assert np.allclose(t.attributions(x[:1], 4)[0], phi)


def plain_boost(x, y, cuts, trees, depth, eta, ridge, weight):
    """The same fit in plain Python: margins of the rows."""
    margin = np.zeros(len(x))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, weight, 1.0)
        g, h = w * (p - y), w * p * (1 - p)
        out = np.zeros(len(x))

        def grow(rows, level):
            G, H = g[rows].sum(), h[rows].sum()
            best = None
            for f in range(x.shape[1]) if level < depth else ():
                for b, c in enumerate(cuts[f]):
                    low = rows & (x[:, f] <= c)
                    if low.sum() in (0, rows.sum()):
                        continue
                    gl, hl = g[low].sum(), h[low].sum()
                    if min(hl, H - hl) < 1:
                        continue
                    gain = (gl**2 / (hl + ridge) + (G - gl)**2 / (H - hl + ridge) - G**2 / (H + ridge)) / 2
                    if gain > 1e-12 and (best is None or round(gain, 9) > best[0]):
                        best = (round(gain, 9), f, c)
            if best is None:
                out[rows] = -eta * G / (H + ridge)
                return
            grow(rows & (x[:, best[1]] <= best[2]), level + 1)
            grow(rows & ~(x[:, best[1]] <= best[2]), level + 1)

        grow(np.ones(len(x), bool), 0)
        margin += out
    return margin


def test_boosting_equals_plain_python(spark, fitted):
    df, x, y, _ = fitted
    model = boosting.boost(df, "id", NAMES, trees=12, depth=3, bins=16, eta=0.5)
    rows = df.toDF("id", "a", "b", "c", "d", "label")
    cuts = boosting.fit_cuts(rows, ["a", "b", "c", "d"], 16)
    plain = plain_boost(x, y, cuts, 12, 3, 0.5, 1.0, (y == 0).sum() / (y == 1).sum())
    assert np.allclose(model.trees.margin(x), plain)
    assert abs(sum(v for _, v in model.importance()) - 1) < 1e-12


def test_boosting_learns_and_draws_rows_and_columns(spark, fitted):
    df, x, y, _ = fitted
    model = boosting.boost(df, "id", NAMES, trees=12, depth=3, bins=32, eta=0.6, subsample=0.8, column_share=0.5)
    again = boosting.boost(df.repartition(7), "id", NAMES, trees=12, depth=3, bins=32, eta=0.6, subsample=0.8, column_share=0.5)
    assert np.allclose(model.trees.margin(x), again.trees.margin(x))
    m = model.trees.margin(x)
    order = np.argsort(m)
    ranks = np.empty(len(m))
    ranks[order] = np.arange(1, len(m) + 1)
    auc = (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.9


def test_sparse_sums_equal_dense_ones(spark, fitted, monkeypatch):
    df, x, _, _ = fitted
    dense = boosting.boost(df, "id", NAMES, trees=2, depth=3, bins=16).trees.margin(x)
    monkeypatch.setattr(boosting, "DENSE", 0)
    assert np.allclose(boosting.boost(df, "id", NAMES, trees=2, depth=3, bins=16).trees.margin(x), dense)


def test_odd_tables(spark):
    empty = frame(spark, np.empty((0, 4)), [])
    none = boosting.boost(empty, "id", NAMES, trees=3)
    assert none.trees.margin(np.zeros((2, 4))).tolist() == [0, 0]
    assert explain.tree_attributions(empty, "id", NAMES, none.trees).count() == 0
    one = frame(spark, [[1.0, np.nan, 2.0, 3.0]] * 5, [1.0] * 5)  # one class, one value, no number in a column
    model = boosting.boost(one, "id", NAMES, trees=3)
    assert model.trees.margin(np.array([[1.0, np.nan, 2.0, 3.0]]))[0] > 0
    assert [r["contribution"] for r in explain.tree_attributions(one, "id", NAMES, model.trees).collect()] == [0.0] * 20


def few(spark):
    class FewRows(Trees):
        """Trees that refuse to explain more rows at once than there are ways through them."""

        def attributions(self, x, features):
            assert len(x) <= 6
            return Trees.attributions(self, x, features)

    rows = [(i, None if i % 50 == 0 else float("nan") if i % 50 == 1 else float(i % 7), float(i % 11)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    own = (np.array([0]), np.array([0, 1, 1, -1, -1, -1, -1]), np.array([3.0, 4.5, 8.0, 0, 0, 0, 0]), np.array([1, 3, 5, -1, -1, -1, -1]),
           np.array([2, 4, 6, -1, -1, -1, -1]), np.array([0, 0, 0, 0.9, 0.7, 0.4, 0.1]), np.array([10.0, 6, 4, 2, 4, 3, 1]))
    return df, np.array([[np.nan if r[1] is None else r[1], r[2]] for r in rows]), FewRows(*own), Trees(*own)


def test_rows_between_the_same_cuts_are_explained_once(spark):
    df, x, t, plain = few(spark)
    got = {(r["id"], r["feature"]): r["contribution"] for r in explain.tree_attributions(df, "id", ["a", "b"], t).collect()}
    assert len(got) == 1800 and np.allclose([[got[i, "a"], got[i, "b"]] for i in range(900)], plain.attributions(x, 2))
    both = {(r["id"], r["feature1"], r["feature2"]): r["contribution"] for r in explain.tree_interactions(df, "id", ["a", "b"], t).collect()}
    assert len(both) == 2700 and np.allclose([both[i, "a", "b"] for i in range(900)], 2 * plain.interactions(x, 2)[:, 0, 1])
    twice = df.unionByName(df.where("a < 2"))
    weight = np.where(x[:, 0] < 2, 2, 1)
    strength = explain.tree_interaction_strengths(twice, ["a", "b"], t).first()["strength"]
    assert abs(strength - np.average(2 * np.abs(plain.interactions(x, 2)[:, 0, 1]), weights=weight)) < 1e-12


def test_looked_up_answers_equal_integrated_ones(fitted, monkeypatch):
    _, x, _, model = fitted
    t = model.trees
    looked = t.attributions(x, 4), t.interactions(x, 4)
    monkeypatch.setattr("retenta.plans.trees.TABLED", 0)
    assert all(np.allclose(a, b, atol=1e-12) for a, b in zip(looked, (t.attributions(x, 4), t.interactions(x, 4))))
