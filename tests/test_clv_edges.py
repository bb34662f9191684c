"""Expected purchases and values where parameters are at most one, against numeric integration."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from retenta.operators import clv as V


def integral(r, alpha, a, b, t, x, tx, T, n=400_000):
    """Mean of (1 - (1 + p t / (alpha + T)) ** -(r + x)) / p for p from Beta(a, b + x), times the chance to be alive."""
    p = ((np.arange(n) + 0.5) / n) ** (1 / a)
    weight = (1 - p) ** (b + x - 1) / a * math.gamma(a + b + x) / (math.gamma(a) * math.gamma(b + x))
    gone = a / (b + x - 1) * ((alpha + T) / (alpha + tx)) ** (r + x) if x > 0 else 0.0
    return float((weight * (1 - (1 + p * t / (alpha + T)) ** -(r + x)) / p).mean() / (1 + gone))


@pytest.mark.parametrize("a, b", [(0.4, 2.0), (0.5, 0.5 + 1e-12), (1.0, 1.5), (1.00005, 1.5), (0.9999, 1.5), (2.5, 1.2)])
def test_expected_purchases(a, b):
    x, tx, T = np.array([0.0, 1.0, 7.0]), np.array([0.0, 20.0, 80.0]), np.array([30.0, 40.0, 90.0])
    got = V._expected(0.7, 5.0, a, b, 60.0, x, tx, T)
    rows = range(1 if b < 1 else 0, 3)  # the integrand has a pole at one where b + x < 1
    assert [got[i] for i in rows] == pytest.approx([integral(0.7, 5.0, a, b, 60.0, x[i], tx[i], T[i]) for i in rows], rel=1e-4)
    assert np.isfinite(got).all() and (got > 0).all()


def test_a_series_that_does_not_converge_raises():
    one = np.ones(1)
    with pytest.raises(V.NotConverged):
        V._c_hyp2f1(one, one, one, one * (1 - 1e-9), most=1000)


def test_predictions_with_nulls_and_small_parameters(spark):
    rows = [(1, 0, 0.0, 30.0, 10.0), (2, 3, 20.0, 40.0, 12.0), (3, None, 1.0, 2.0, 1.0)]
    s = spark.createDataFrame(rows, "customer_id long, frequency long, recency double, T double, monetary_value double")
    fit = V.Fit((0.7, 5.0, 1.0, 0.5), 0.0, 2)
    for q in (0.5, 1.0, 3.0):
        got = {r["customer_id"]: r["predicted_clv"] for r in V.predict_clv(s, "customer_id", fit, V.Fit((2.0, q, 4.0), 0.0, 2)).collect()}
        assert got[1] > 0 and 0 < got[2] < 1e5 and got[3] is None
    p, q, v = 2.0, 3.0, 4.0
    one = s.where("customer_id = 2").select(V.expected_value_per_purchase(V.Fit((p, q, v), 0.0, 2), F.col("frequency"), F.col("monetary_value")).alias("e")).first()["e"]
    own = p * 3 / (p * 3 + q - 1)
    assert one == pytest.approx((1 - own) * v * p / (q - 1) + own * 12.0)
