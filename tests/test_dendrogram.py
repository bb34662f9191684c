"""Ward's dendrogram against a plain agglomeration."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retenta.operators import segments as G


def plain_ward(points, sizes):
    """Merges (members of both, height) in the order of lowest cost, all pairs each time."""
    groups = {i: (frozenset([i]), np.array(p, float), float(w)) for i, (p, w) in enumerate(zip(points, sizes))}
    out, new = [], len(points)
    while len(groups) > 1:
        cost, a, b = min((2 * g[2] * h[2] / (g[2] + h[2]) * ((g[1] - h[1]) ** 2).sum(), i, j) for i, g in groups.items() for j, h in groups.items() if i < j)
        g, h = groups.pop(a), groups.pop(b)
        groups[new] = (g[0] | h[0], (g[1] * g[2] + h[1] * h[2]) / (g[2] + h[2]), g[2] + h[2])
        out.append((groups[new][0], np.sqrt(cost)))
        new += 1
    return out


@pytest.mark.parametrize("n,d", [(1, 2), (2, 1), (7, 2), (60, 3)])
def test_linkage_equals_plain_ward(n, d):
    rng = np.random.default_rng(n)
    points, sizes = rng.normal(size=(n, d)), rng.integers(1, 9, n)
    link = G.ward_linkage(points, sizes)
    members = {i: frozenset([i]) for i in range(n)}
    for i, (a, b, height, size) in enumerate(link):
        members[n + i] = members[int(a)] | members[int(b)]
        assert size == sum(sizes[j] for j in members[n + i])
    plain = plain_ward(points, sizes)
    assert [members[n + i] for i in range(n - 1)] == [m for m, _ in plain]
    assert np.allclose(link[:, 2], [h for _, h in plain])
    for k in range(1, n + 1):
        labels = G.cut_linkage(link, k)
        assert len(set(labels)) == k and labels[0] == 0
        for m, _ in plain[:n - k]:
            assert len({labels[j] for j in m}) == 1


def test_ties_and_equal_points():
    link = G.ward_linkage(np.zeros((6, 2)), np.ones(6))
    assert link[:, 2].tolist() == [0.0] * 5 and link[-1, 3] == 6
    square = G.ward_linkage(np.array([[0, 0], [0, 1], [1, 0], [1, 1.0]]), np.ones(4))
    assert np.allclose(square[:, 2], [1, 1, np.sqrt(2)])


def test_choose_k_for_both_methods(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(10 * (i % 3), 0.5), rng.gauss(-10 * (i % 3), 0.5)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    out = G.choose_k(df, "id", ["x", "y"], max_clusters=5, method="hierarchical").collect()
    assert [r["n_clusters"] for r in out if r["best"]] == [3] and {r["n_clusters"] for r in out} == {2, 3, 4, 5} and {r["inertia"] for r in out} == {0.0}
    found = G.hierarchical_segments(df, "id", ["x", "y"], k=None).withColumn("kind", F.col("id") % 3)
    assert found.select("segment", "kind").distinct().count() == 3 and found.count() == 90
    vec = G.standardised(df, "id", ["x", "y"])
    table = G.Dendrogram.fit(vec, 40).table(spark)
    assert table.count() >= 30 and table.agg(F.max("size")).first()[0] == 90
    with pytest.raises(ValueError):
        G.choose_k(df, "id", ["x", "y"], method="other")
