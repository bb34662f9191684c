"""Randomised components against the exact ones; codes of texts under one prefix."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from retenta.operators.cleaning import fit_codes
from retenta.operators.widepca import fit_wide_pca, project


def entries(spark, a):
    return spark.createDataFrame([(int(i), f"c{j}", float(a[i, j])) for i, j in np.argwhere(a != 0)], "row long, column string, value double")


def table(rows=60, cols=30, rank=4, seed=3):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(rows, rank)) @ (rng.normal(size=(rank, cols)) * np.array([5.0, 3.0, 2.0, 1.0])[:rank, None]) + rng.normal(size=cols)
    a[rng.random(a.shape) < 0.2] = 0.0
    return a


@pytest.mark.parametrize("extra", [10, 40])
def test_components(spark, extra):
    a = table()
    fit = fit_wide_pca(entries(spark, a), 3, extra=extra)
    c = a - a.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    got = [r["variance"] for r in fit.components.orderBy("component").collect()]
    assert got == pytest.approx((s[:3] ** 2 / (len(a) - 1)).tolist(), rel=1e-9 if extra == 40 else 1e-3)
    if extra == 40:
        rows = {r["column"]: r["loadings"] for r in fit.loadings.collect()}
        v = np.array([rows[f"c{j}"] for j in range(a.shape[1])])
        assert np.abs(np.abs((v * vt[:3].T).sum(axis=0)) - 1).max() < 1e-8 and (v.sum(axis=0) > 0).all()
        scores = {r["row"]: r["scores"] for r in project(entries(spark, a), fit).collect()}
        assert np.array([scores[i] for i in range(len(a))]) == pytest.approx(c @ v, abs=1e-6)


def test_rows_without_entries_count(spark):
    a = table(20, 6, 3)
    a[5:9] = 0.0
    fit = fit_wide_pca(entries(spark, a), 6, rows=20)
    got = [r["variance"] for r in fit.components.orderBy("component").collect()]
    assert got == pytest.approx(np.sort(np.linalg.eigvalsh(np.cov(a.T)))[::-1].tolist(), rel=1e-6)


def test_nulls_constant_and_empty(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "a", 2.0), (None, "a", 1.0), (1, None, 1.0), (1, "b", None)], "row long, column string, value double")
    assert all(r["variance"] == pytest.approx(0, abs=1e-12) for r in fit_wide_pca(df, 2).components.collect())
    empty = fit_wide_pca(df.limit(0), 2)
    assert empty.components.count() == 0 and empty.loadings.count() == 0 and empty.rows == 0


def test_more_columns_than_a_square_matrix_could_have(spark):
    n = 20000
    df = spark.range(n * 3).select((F.col("id") % 50).alias("row"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("string").alias("column"))
    df = df.distinct().withColumn("value", (F.col("row") % 5).cast("double"))
    fit = fit_wide_pca(df, 2, extra=4, steps=1)
    assert fit.loadings.count() > 15000 and fit.components.count() == 2


def test_urls_with_one_prefix_spread_over_all_tasks(spark):
    prefix = "https://www.example.com/shop/catalogue/id"
    urls = spark.range(1_000_000).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("url"))
    codes = fit_codes(urls, ["url"])
    sizes = [pq.read_metadata(f.removeprefix("file://").removeprefix("file:")).num_rows for f in codes.inputFiles()]
    assert sum(sizes) >= 1_000_000 and max(sizes) < 500_000
    got = codes.agg(F.min("code"), F.max("code"), F.count_distinct("code"), F.count_if(F.col("value") == prefix + "10")).first()
    assert list(got) == [0, 999_999, 1_000_000, 1]
    assert codes.where(F.col("value") == prefix + "10").first()["code"] == 2


def test_full_width_takes_two_rounds(spark, monkeypatch):
    from retenta.operators import widepca

    rounds = []
    monkeypatch.setattr(widepca, "_whiten", lambda gram, own=widepca._whiten: rounds.append(len(gram)) or own(gram))
    a = table(50, 8, 4)
    got = [r["variance"] for r in fit_wide_pca(entries(spark, a), 8).components.orderBy("component").collect()]
    assert rounds == [8, 8] and got == pytest.approx(np.sort(np.linalg.eigvalsh(np.cov(a.T)))[::-1].tolist(), rel=1e-9)
