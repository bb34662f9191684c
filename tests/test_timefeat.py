import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from retenta.operators import timefeat as T
from retenta.params import Transactions
from retenta.streaming import operators as ST

TX = Transactions()
BASE = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, date timestamp_ntz, value double")


def busy(n=600):
    rng = random.Random(3)
    return [("hot" if i % 2 else f"c{i % 7}", BASE + dt.timedelta(hours=rng.randint(0, 2000)), float(rng.randint(1, 50))) for i in range(n)]


def test_rolling_is_left_open_and_sees_ties(spark):
    rows = busy() + [("x", BASE, 1.0), ("x", BASE, 2.0), ("x", BASE + dt.timedelta(days=7), 4.0)]
    keyed = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(keyed, "id long, customer_id string, date timestamp_ntz, value double")
    got = {r["id"]: r for r in T.rolling_features(df, (7, 30)).collect()}
    assert len(got) == len(rows)
    for i, c, t, _ in keyed:
        for d in (7, 30):
            inside = [v for _, c2, t2, v in keyed if c2 == c and t - dt.timedelta(days=d) < t2 <= t]
            assert got[i][f"rolling_{d}d_count"] == len(inside)
            assert got[i][f"rolling_{d}d_sum"] == pytest.approx(sum(inside))


def test_sessions_split_only_above_the_gap(spark):
    h = lambda x: BASE + dt.timedelta(hours=x)
    df = frame(spark, [("a", h(0), 1.0), ("a", h(24), 2.0), ("a", h(49), 4.0), ("b", h(5), 8.0)])
    got = {(r["customer_id"], r["session_id"]): r for r in T.sessions(df).collect()}
    assert set(got) == {("a", 1), ("a", 2), ("b", 1)}
    assert got["a", 1]["session_sum"] == 3.0 and got["a", 1]["session_duration_hours"] == 24.0
    assert got["a", 2]["gap_hours_sum"] == 25.0 and got["b", 1]["gap_hours_sum"] == 0.0


def test_sessions_of_busy_customer_match_brute_force(spark):
    rows = busy()
    got = {(r["customer_id"], r["session_id"]): r["session_count"] for r in T.sessions(frame(spark, rows), 6).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        last, sid = None, 0
        for t in sorted(r[1] for r in rows if r[0] == c):
            if last is None or t - last > dt.timedelta(hours=6):
                sid += 1
            want[c, sid] = want.get((c, sid), 0) + 1
            last = t
    assert got == want


def test_rfm_of_one_purchase(spark):
    df = frame(spark, [("a", BASE, 10.0), ("b", BASE + dt.timedelta(days=10, hours=23), 5.0)])
    got = {r["customer_id"]: r for r in T.rfm_features(df).collect()}
    assert got["a"]["recency_days"] == 10 and got["a"]["frequency"] == 1
    assert got["a"]["monetary_std"] is None and got["a"]["transaction_rate"] == 1.0


def test_rfm_scores_run_from_one_to_five(spark):
    rows = [(f"c{i}", BASE + dt.timedelta(days=i), float(i)) for i in range(50) for _ in range(i % 9 + 1)]
    got = T.rfm_scores(T.rfm_features(frame(spark, rows)))
    assert {r[0] for r in got.select("recency_score").distinct().collect()} == {1, 2, 3, 4, 5}
    newest = got.where("customer_id = 'c49'").first()
    assert newest["recency_score"] == 5 and newest["monetary_score"] == 5


def test_behaviour_has_the_mean(spark):
    df = frame(spark, [("a", BASE, 10.0), ("a", BASE + dt.timedelta(days=5), 20.0)])
    r = T.behaviour_patterns(df).first()
    assert r["value_mean"] == 15.0 and r["spending_range"] == 10.0 and r["weekend_share"] == 0.5


def test_trend_periods_nest(spark):
    days = [0, 60, 120, 170, 179]
    df = frame(spark, [("a", BASE + dt.timedelta(days=d), 1.0) for d in days] + [("old", BASE - dt.timedelta(days=40), 9.0)])
    got = {r["customer_id"]: r for r in T.trend_features(df).collect()}
    assert "old" not in got
    assert (got["a"]["trend_30d_count"], got["a"]["trend_90d_count"], got["a"]["trend_180d_count"]) == (2, 3, 5)


def test_batch_session_window_agrees(spark):
    df = frame(spark, busy())
    a = T.sessions(df).groupBy("customer_id").count()
    b = ST.session_totals(df).groupBy("customer_id").count().withColumnRenamed("count", "k")
    assert a.join(b, "customer_id").where("count = k").count() == a.count()


def test_rolling_sums_keep_small_values_after_large_ones(spark):
    at = lambda day: dt.datetime(2024, 1, 1, 12) + dt.timedelta(days=day)
    rows = [(1, 1, at(0), 1e16), (2, 1, at(8), 0.1), (3, 1, at(9), 0.2), (4, 1, at(15), 0.4), (5, 2, at(9), 5.0),
            (6, 1, at(22), 0.8), (7, 1, None, 1.0), (8, 2, at(16), None)]
    df = spark.createDataFrame(rows, "id long, customer_id long, ts timestamp, amount double")
    tx = Transactions(customer="customer_id", date="ts", value="amount")
    got = {r["id"]: r for r in T.rolling_features(df, (7,), tx).collect()}
    assert len(got) == len(rows)
    for i, want in {1: 1e16, 2: 0.1, 3: 0.1 + 0.2, 4: 0.2 + 0.4, 5: 5.0, 6: 0.8}.items():
        assert got[i]["rolling_7d_sum"] == want
    assert [got[i]["rolling_7d_count"] for i in (1, 2, 3, 4, 5, 6, 8)] == [1, 1, 2, 2, 1, 1, 0]
    assert got[7]["rolling_7d_sum"] is None and got[8]["rolling_7d_sum"] is None
