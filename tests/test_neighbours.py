"""Nearest-neighbour mutual information against all distances."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from retenta.operators.neighbours import digamma, neighbour_mutual_information


def psi(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, n))


def plain(v, c, k=3):
    keep = np.array([x is not None and math.isfinite(x) and y is not None and sum(1 for a, b in zip(v, c) if b == y and a is not None and math.isfinite(a)) > 1
                     for x, y in zip(v, c)], bool)
    v, c = np.array([x for x, g in zip(v, keep) if g], float), [y for y, g in zip(c, keep) if g]
    if not len(v):
        return 0.0
    ks, ns, ms = [], [], []
    for i in range(len(v)):
        d = np.abs(v - v[i])
        own = sorted(d[j] for j in range(len(v)) if j != i and c[j] == c[i])
        ns.append(len(own) + 1)
        r = own[min(k, len(own)) - 1]
        ks.append(min(k, len(own)) if r > 0 else own.count(0) + 1)
        ms.append(int((d < r).sum() if r > 0 else (d == 0).sum()))
    return max(0.0, psi(len(v)) + np.mean([psi(x) for x in ks]) - np.mean([psi(x) for x in ns]) - np.mean([psi(x) for x in ms]))


@pytest.mark.parametrize("block", [7, 50_000])
def test_equals_all_distances(spark, block):
    rng = np.random.default_rng(4)
    n = 300
    c = [None if rng.random() < 0.02 else int(rng.integers(0, 3)) for _ in range(n - 1)] + [9]
    shift = np.array([0 if x is None else x for x in c])
    cols = {"smooth": rng.normal(size=n) + shift, "ties": (rng.integers(0, 8, n) + 3 * shift).astype(float), "noise": np.round(rng.random(n), 1),
            "odd": np.where(rng.random(n) < 0.1, np.nan, rng.normal(size=n)), "same": np.full(n, 2.5), "far": rng.normal(size=n) * 1e9 + 1e15}
    rows = [(*(None if name == "odd" and i % 7 == 0 else float(col[i]) for name, col in cols.items()), c[i]) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{x}` double" for x in cols) + ", label int").repartition(3)
    got = {r["feature"]: r["score"] for r in neighbour_mutual_information(df, list(cols), block=block).collect()}
    for j, name in enumerate(cols):
        assert got[name] == pytest.approx(plain([r[j] for r in rows], c), abs=1e-9), name
    assert got["ties"] > got["noise"] and got["smooth"] > 0.1


def test_nothing_to_compare(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (None, 1)], "x double, label int")
    assert [r["score"] for r in neighbour_mutual_information(df, ["x"]).collect()] == [0.0]
    assert [r["score"] for r in neighbour_mutual_information(df.where("x > 5"), ["x"]).collect()] == [0.0]


def test_digamma(spark):
    rows = spark.range(1, 60).select("id", digamma(F.col("id").cast("double")).alias("p")).collect()
    assert all(abs(r["p"] - psi(r["id"])) < 1e-11 for r in rows)
