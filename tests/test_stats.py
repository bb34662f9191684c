import math

import pytest
from pyspark.sql import functions as F

from retenta.functions import pvalues as P
from retenta.operators import stats as S


def test_tail_probabilities():
    assert P.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert P.chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05)
    assert P.normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    # t = 2.228138851964939 is the 97.5% point for 10 degrees of freedom
    t = 2.2281388519649385
    assert P.correlation_tail(t / math.sqrt(10 + t * t), 12) == pytest.approx(0.05)
    assert P.fisher_two_sided(8, 2, 1, 5) == pytest.approx(0.03496503496503495)
    assert P.mann_whitney_exact(0, 5, 5) == pytest.approx(2 / 252)
    assert P.mann_whitney_exact(4.0, 2, 4) == pytest.approx(1.0)


def test_mann_whitney_small_sample_is_exact(spark):
    df = spark.createDataFrame([(float(i), int(i > 5)) for i in range(1, 11)], "x double, label int")
    r = S.mann_whitney(df, ["x"], "label").first()
    assert r["statistic"] == 25.0 and r["effect_size"] == -1.0 and r["p_value"] == pytest.approx(2 / 252)


def test_mann_whitney_needs_rows(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1)], "x double, label int")
    r = S.mann_whitney(df, ["x"], "label").first()
    assert r["interpretation"] == "insufficient_data" and r["p_value"] is None and not r["is_significant"]


def test_chi_square_two_by_two_is_corrected(spark):
    cells = {("a", 0): 20, ("a", 1): 10, ("b", 0): 10, ("b", 1): 25}
    df = spark.createDataFrame([k for k, n in cells.items() for _ in range(n)], "c string, label int")
    r = S.chi_square(df, ["c"], "label").first()
    n, ad_bc = 65, 20 * 25 - 10 * 10
    want = n * (abs(ad_bc) - n / 2) ** 2 / (30 * 35 * 30 * 35)
    assert r["statistic"] == pytest.approx(want)
    assert r["effect_size"] == pytest.approx(math.sqrt(want / n))


def test_chi_square_with_an_empty_cell(spark):
    df = spark.createDataFrame([("a", 0)] * 20 + [("b", 1)] * 20, "c string, label int")
    r = S.chi_square(df, ["c"], "label").first()
    assert r["statistic"] == pytest.approx(40 * (20 * 20 - 20) ** 2 / (20**4))


def test_fisher_and_dispatch(spark):
    df = spark.createDataFrame([("a", 0, 1.0)] * 8 + [("a", 1, 2.0)] * 2 + [("b", 0, 3.0)] + [("b", 1, 4.0)] * 5, "c string, label int, x double")
    f = S.fisher_exact(df, ["c"], "label").first()
    assert f["statistic"] == 20.0 and f["p_value"] == pytest.approx(0.034965034965)
    kinds = {r["column"]: r["test_name"] for r in S.test_all(df, "label").collect()}
    assert kinds == {"c": "Fisher's exact", "x": "Mann-Whitney U"}


def test_kruskal_small_groups_are_dropped(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (3.0, "a"), (4.0, "b"), (5.0, "b"), (6.0, "b"), (9.0, "c")], "x double, g string")
    r = S.kruskal_wallis(df, "x", "g").first()
    assert r["statistic"] == pytest.approx(3.857142857) and r["degrees_of_freedom"] == 1


def test_holm_steps_down(spark):
    t = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", None)], "column string, p_value double")
    got = {r["column"]: r["p_value_corrected"] for r in S.correct_p_values(t, "holm").collect()}
    assert got["a"] == pytest.approx(0.03) and got["c"] == pytest.approx(0.06) and got["b"] == pytest.approx(0.06) and got["d"] is None


def test_spearman_with_missing_values_ranks_each_pair(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (None, 9.0), (3.0, 5.0), (4.0, 4.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    r = S.correlation_pairs(df, ["a", "b"], "spearman").first()
    assert r["n"] == 4 and r["r"] == pytest.approx(0.6)


def test_cramers_v_of_identical_columns_is_one(spark):
    df = spark.createDataFrame([(v, v, "k") for v in "aaabbbccc"], "x string, y string, z string")
    got = {(r["col1"], r["col2"]): r["v"] for r in S.cramers_v_pairs(df, ["x", "y", "z"]).collect()}
    assert got["x", "y"] == pytest.approx(1.0) and got["x", "z"] == 0.0 and got["z", "z"] == 1.0


def test_mann_whitney_exact_counts_arrangements():
    from itertools import combinations

    from retenta.functions.pvalues import mann_whitney_exact

    for n1, n2 in ((1, 5), (3, 4), (4, 6), (7, 3)):
        us = [sum(c) - n1 * (n1 + 1) // 2 for c in combinations(range(1, n1 + n2 + 1), n1)]
        for u in range(n1 * n2 + 1):
            top = max(u, n1 * n2 - u)
            want = min(1.0, 2 * sum(x >= top for x in us) / len(us))
            assert abs(mann_whitney_exact(u, n1, n2) - want) < 1e-12
    assert 0 < mann_whitney_exact(8 * 10**12 * 0.1, 8, 10**12) < 0.01  # large groups cost no memory


def test_fisher_sums_the_tails():
    from math import comb

    from retenta.functions.pvalues import fisher_two_sided

    for a, b, c, d in ((8, 2, 1, 5), (3, 3, 3, 3), (0, 10, 12, 2), (1, 0, 0, 1), (5, 0, 7, 0), (20, 31, 44, 9)):
        r1, r2, c1 = a + b, c + d, a + c
        p = {k: comb(r1, k) * comb(r2, c1 - k) / comb(r1 + r2, c1) for k in range(max(0, c1 - r2), min(r1, c1) + 1)}
        want = min(1.0, sum(v for v in p.values() if v <= p[a] * (1 + 1e-7)))
        assert abs(fisher_two_sided(a, b, c, d) - want) < 1e-9
