"""Parallel isotonic regression against plain pooling of adjacent violators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from retenta.plans.isotonic import apply_isotonic, fit_isotonic


def plain(x, y, w):
    """Fitted value of each distinct x by the largest smallest mean of the intervals around it."""
    xs = np.unique(x)
    cw = np.array([w[x == v].sum() for v in xs]).cumsum()
    cs = np.array([(w * y)[x == v].sum() for v in xs]).cumsum()
    cw, cs = np.append(0, cw), np.append(0, cs)
    n = len(xs)
    return xs, np.array([max(min((cs[b] - cs[a]) / (cw[b] - cw[a]) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)])


def cases():
    rng = np.random.default_rng(2)
    n = 240
    x = np.round(rng.random(n), 2)
    yield "noisy", x, (rng.random(n) < x).astype(float), np.ones(n)
    yield "weighted", x, rng.normal(size=n) + x, rng.random(n) + 0.1
    yield "falling", np.arange(90.0), -np.arange(90.0), np.ones(90)
    yield "rising", np.arange(90.0), np.arange(90.0), np.ones(90)
    yield "one long block", np.arange(60.0), np.r_[np.arange(20.0), [100.0], np.full(38, 19.5), [200.0]], np.ones(60)
    yield "sawtooth", np.arange(120.0), np.arange(120) // 10 - (np.arange(120) % 10) * 3.0, np.ones(120)
    yield "one score", np.zeros(5), np.array([0, 1, 1, 0, 1.0]), np.ones(5)


@pytest.mark.parametrize("name,x,y,w", list(cases()), ids=[c[0] for c in cases()])
def test_equals_plain_pooling(spark, name, x, y, w):
    df = spark.createDataFrame(list(map(tuple, np.column_stack([x, y, w]).tolist())), "score double, label double, weight double").repartition(3)
    model = fit_isotonic(df, weight="weight", per_range=13)
    xs, want = plain(x, y, w)
    got = {r["score"]: r["c"] for r in apply_isotonic(df, model, name="c").select("score", "c").distinct().collect()}
    assert np.allclose([got[v] for v in xs], want)
    # between and beyond the scores
    mids = np.r_[xs[0] - 1, (xs[1:] + xs[:-1]) / 2, xs[-1] + 1]
    asked = spark.createDataFrame([(float(v),) for v in mids], "score double")
    back = {r["score"]: r["c"] for r in apply_isotonic(asked, model, name="c").collect()}
    assert np.allclose([back[v] for v in mids], np.interp(mids, xs, want))


def test_nulls_ties_and_nothing(spark):
    rows = [(0.2, 1.0), (0.2, 0.0), (None, 1.0), (0.9, None), (0.9, 1.0), (-0.0, 0.0), (0.0, 1.0), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "score double, label double").withColumn("lo", F.lit("clash"))
    out = apply_isotonic(df, fit_isotonic(df), name="c").collect()
    assert len(out) == len(rows) and {r["c"] for r in out if r["score"] is None} == {None}
    assert {r["c"] for r in out if r["score"] in (0.0, 0.2)} == {0.5} and {r["c"] for r in out if r["score"] == 0.9} == {1.0}
    empty = df.where("score > 5")
    assert {r["c"] for r in apply_isotonic(df, fit_isotonic(empty), name="c").collect()} == {None}
