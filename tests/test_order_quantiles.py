import random

import numpy as np
from pyspark.sql import Window as W, functions as F

from retenta.plans.order import average_ranks, running_totals, with_rank
from retenta.plans.quantiles import fit_quantiles, quantiles


def hot_rows(spark, n=3000):
    """A third of the rows share one key; some keys are missing."""
    rng = random.Random(1)
    rows = []
    for i in range(n):
        key = 7.0 if i % 3 == 0 else (None if i % 50 == 1 else round(rng.random() * 20, 2))
        rows.append((i, f"id{i}", "a" if i % 3 else "b", key, rng.randint(0, 9)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id long, name string, g string, k double, v long").repartition(6)


def test_rank_equals_single_window(spark):
    df = hot_rows(spark)
    for descending in (False, True):
        col = F.col("k").desc() if descending else F.col("k").asc()
        want = df.select("id", F.row_number().over(W.orderBy(col, "id")).alias("w"))
        got = with_rank(df, "k", "id", descending=descending)
        assert got.join(want, "id").where("rank = w").count() == 3000


def test_rank_by_group_and_text_tie(spark):
    df = hot_rows(spark)
    got = with_rank(df, "k", "name", by=["g"])
    want = df.select("id", F.row_number().over(W.partitionBy("g").orderBy("k", F.xxhash64("name"), "name")).alias("w"))
    assert got.join(want, "id").where("rank = w").count() == 3000


def test_hot_key_spreads_over_bins(spark):
    from retenta.plans.order import BIN, TIE_BIN, assign_bins

    per = assign_bins(hot_rows(spark), "k", "id").groupBy(BIN, TIE_BIN).count()
    assert per.agg(F.max("count")).first()[0] < 3000 / 4


def test_running_totals(spark):
    df = hot_rows(spark).where("k is not null")
    got = running_totals(df, "k", {"s": F.col("v")}, tie="id", by=["g"])
    want = df.select("id", F.sum("v").over(W.partitionBy("g").orderBy("k", "id")).alias("w"))
    assert got.join(want, "id").where("s = w").count() == df.count()


def test_planning_does_not_grow_with_the_search(spark):
    df = hot_rows(spark).where("k is not null")
    threads = spark._jvm.java.lang.management.ManagementFactory.getThreadMXBean()

    def allocated(bins):
        """Bytes that the driver needs to plan it; the second time, when classes are loaded."""
        for _ in range(2):
            out = running_totals(df, "k", {"s": F.col("v")}, tie="id", by=["g"], bins=bins)
            before = threads.getCurrentThreadAllocatedBytes()
            out._jdf.queryExecution().executedPlan()
            used = threads.getCurrentThreadAllocatedBytes() - before
        return used

    assert allocated(256) < 4 * allocated(16)


def test_average_ranks_of_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (4.0,)], "x double")
    assert {r["x"]: r["avg_rank"] for r in average_ranks(df, "x").collect()} == {1.0: 1.0, 2.0: 2.5, 4.0: 4.0}


def test_quantiles_match_numpy(spark):
    df = hot_rows(spark)
    probs = [0, 0.01, 0.25, 0.5, 0.8, 0.99, 1]
    pdf = df.toPandas()
    want = np.quantile(pdf["k"].dropna(), probs)
    assert np.allclose(fit_quantiles(df, ["k"], probs)["k"], want)
    assert np.allclose(fit_quantiles(df, ["k"], probs, bins=3)["k"], want)  # coarse cuts, same result
    for r in quantiles(df, ["k", "v"], probs, ["g"]).collect():
        part = pdf[pdf["g"] == r["g"]][r["column"]].dropna()
        assert np.isclose(r["value"], np.quantile(part, r["prob"]))


def test_quantiles_of_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert fit_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}
