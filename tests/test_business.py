import random

import pytest
from pyspark.sql import functions as F

from retenta.operators import business as B
from retenta.operators import fairness as E
from retenta.params import BusinessParams
from retenta.plans.scoretable import calibration_bins, calibration_errors, metric_set


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(42)
    out = []
    for i in range(503):
        y = int(rng.random() < 0.3)
        out.append((i, y, round(min(0.99, max(0.01, rng.random() * 0.7 + 0.3 * y)), 2), "abc"[i % 3]))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, label int, score double, segment string")


def test_auc_and_average_precision(df, rows):
    pos, neg = [r[2] for r in rows if r[1]], [r[2] for r in rows if not r[1]]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for s in sorted({r[2] for r in rows}, reverse=True):
        tp, n = sum(p >= s for p in pos), sum(r[2] >= s for r in rows)
        ap += sum(p == s for p in pos) / len(pos) * tp / n
    m = metric_set(df).first()
    assert m["roc_auc"] == pytest.approx(auc) and m["pr_auc"] == pytest.approx(ap)


def test_single_class_has_no_auc(spark):
    one = spark.createDataFrame([(1, 1, 0.4), (2, 1, 0.6)], "id long, label int, score double")
    m = metric_set(one).first()
    assert m["roc_auc"] is None and m["pr_auc"] is None and m["recall"] == 0.5


def test_profit_and_sweep(df, rows):
    p = BusinessParams(900.0, 40.0, 300.0)
    for r in B.profit_curve(df, p).collect():
        t = r["threshold"]
        tp = sum(1 for x in rows if x[1] and x[2] >= t)
        fp = sum(1 for x in rows if not x[1] and x[2] >= t)
        fn = sum(1 for x in rows if x[1] and x[2] < t)
        assert (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn)
        assert r["profit"] == pytest.approx(tp * 900 - (tp + fp) * 40 - fn * 300)
    best = B.optimal_threshold(df, p).first()
    assert best["profit"] == max(r["profit"] for r in B.profit_curve(df, p).collect())


def test_threshold_above_every_score_is_kept(spark):
    low = spark.createDataFrame([(1, 1, 0.05)], "id long, label int, score double")
    assert B.profit_curve(low).count() == 99


def test_lift_table_last_decile_takes_remainder(df):
    t = B.lift_table(df, "id").orderBy("decile").collect()
    assert [r["n_customers"] for r in t] == [50] * 9 + [53]
    assert t[-1]["cumulative_capture_rate"] == pytest.approx(1.0)
    assert all(a["threshold_min"] >= b["threshold_max"] for a, b in zip(t, t[1:]))


def test_lift_table_fewer_rows_than_deciles(spark):
    few = spark.createDataFrame([(i, i % 2, i / 10) for i in range(5)], "id long, label int, score double")
    assert [(r["decile"], r["n_customers"]) for r in B.lift_table(few, "id").collect()] == [(10, 5)]


def test_savings_identities(df):
    s = B.expected_savings(df, 0.5).first()
    assert s["net_savings"] == pytest.approx(s["total_profit"] + s["baseline_churn_cost"])
    assert s["total_customers"] == 503
    none = B.expected_savings(df, 1.1).first()
    assert none["cost_per_retained_customer"] is None and none["roi_percentage"] == 0


def test_capture_rates_are_monotone(df):
    c = [r["capture_rate"] for r in B.capture_rates(df, "id").orderBy("contact_percentage").collect()]
    assert len(c) == 8 and c == sorted(c)


def test_calibration_bins_are_left_open(spark):
    d = spark.createDataFrame([(0, 0.0), (1, 0.1), (1, 0.11), (1, 1.0)], "label int, score double")
    assert {r["bin"]: r["n"] for r in calibration_bins(d).collect()} == {0: 2, 1: 1, 9: 1}
    assert calibration_errors(calibration_bins(d)).first()["mce"] == pytest.approx(0.89)


def test_calibration_slope_minimises_the_penalised_loss(df, rows):
    import math

    got = {r["segment"]: r for r in E.calibration_slopes(df, ["segment"]).collect()}

    def loss(seg, w, b):
        total = 0.5 * w * w
        for _, y, s, g in rows:
            if g == seg:
                z = w * math.log(s / (1 - s)) + b
                total += math.log1p(math.exp(-z)) if y else math.log1p(math.exp(z))
        return total

    for seg, r in got.items():
        w, b = r["calibration_slope"], r["calibration_intercept"]
        for dw, db in ((1e-3, 0), (-1e-3, 0), (0, 1e-3), (0, -1e-3)):
            assert loss(seg, w, b) < loss(seg, w + dw, b + db)


def test_bias_of_identical_groups_is_none(spark):
    same = spark.createDataFrame([(i % 2, 0.9 if i % 4 < 2 else 0.1, g) for g in "ab" for i in range(40)], "label int, score double, segment string")
    assert E.bias_violations(same, ["segment"]).count() == 0
    report = E.fairness_report(same, ["segment"]).first()
    assert report["overall_fair"] and report["recommendations"] == ""


def test_single_class_segment_is_flagged_not_lost(spark):
    d = spark.createDataFrame([(1, 0.9, "x"), (1, 0.8, "x"), (0, 0.2, "y"), (1, 0.7, "y")], "label int, score double, segment string")
    got = {r["segment"]: r["single_class"] for r in E.subgroup_performance(d, ["segment"]).collect()}
    assert got == {"x": True, "y": False}
