import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retenta.operators import clv as V
from retenta.operators import explain as X
from retenta.operators import models as M
from retenta.operators import segments as G
from retenta.operators import transform as T
from retenta.operators.isolation import isolation_outliers


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, a, b, float(rng.random() < 1 / (1 + math.exp(-2 * a)))))
    return spark.createDataFrame(rows, "id long, a double, b double, label double").cache()


def test_logistic_matches_the_penalised_optimum(table):
    df = M.assemble(table, ["a", "b"], ["id", "label"])
    model = M.logistic(400).fit(df)
    rows = [(np.array([r["a"], r["b"]]), r["label"]) for r in table.collect()]

    def loss(w, b):
        z = np.array([x @ w + b for x, _ in rows])
        y = np.array([t for _, t in rows])
        return 0.5 * w @ w + np.sum(np.logaddexp(0, z) - y * z)

    w, b = model.coefficients.toArray(), model.intercept
    for i in range(2):
        for s in (1e-2, -1e-2):
            e = np.zeros(2)
            e[i] = s
            assert loss(w, b) < loss(w + e, b)


def test_cross_validation_and_folds(table):
    df = M.assemble(table, ["a", "b"], ["id", "label"])
    oof = M.out_of_fold(M.logistic(400), df, "id", folds=3)
    assert oof.count() == 400 and oof.select("id").distinct().count() == 400
    cv = {r["metric"]: r["mean"] for r in M.cross_validate(M.logistic(400), df, "id", folds=3).collect()}
    assert set(cv) == set(M.SCORING) and cv["roc_auc"] > 0.75


def test_calibrated_scores_are_probabilities(table):
    df = M.assemble(table, ["a", "b"], ["id", "label"])
    for method in ("isotonic", "sigmoid"):
        s = M.calibrate(M.logistic(400), df, "id", method).score(df, ["id", "label"]).agg(
            F.min("score"), F.max("score"), F.avg("score"), F.count("*")).first()
        assert 0 <= s[0] <= s[1] <= 1 and abs(s[2] - table.agg(F.avg("label")).first()[0]) < 0.05 and s[3] == 400


def test_model_round_trip(table, tmp_path):
    from pyspark.ml.classification import LogisticRegressionModel

    df = M.assemble(table, ["a", "b"], ["id", "label"])
    model = M.logistic(400).fit(df)
    M.save_model(model, str(tmp_path / "m"))
    again = LogisticRegressionModel.load(str(tmp_path / "m"))
    assert M.score_with(model, df, ["id"]).orderBy("id").collect() == M.score_with(again, df, ["id"]).orderBy("id").collect()


def test_registry_changes(spark):
    rows = [(f"m{v}", "churn", "lr", v, "production" if v == 1 else "staging", None, ["x"], {"roc_auc": v / 10}) for v in range(1, 8)]
    reg = spark.createDataFrame(rows, M.REGISTRY_SCHEMA)
    stages = {r["model_id"]: r["stage"] for r in M.promote(reg, "m7").collect()}
    assert stages["m7"] == "production" and stages["m1"] == "archived"
    assert {r["model_id"] for r in M.cleanup(reg, 2).collect()} == {"m7", "m6", "m1"}
    assert M.delete_model(reg, "m1").count() == 7 and M.delete_model(reg, "m1", force=True).count() == 6
    assert M.best_registered(reg).first()["model_id"] == "m7" and M.next_versions(reg).first()["next_version"] == 8


def test_risk_band_edges(spark):
    d = spark.createDataFrame([(0.0,), (0.3,), (0.31,), (0.7,), (1.0,)], "p double")
    assert [r[0] for r in d.select(M.risk_band(F.col("p"))).collect()] == [None, "Low", "Medium", "Medium", "High"]


def test_pipeline_round_trip(spark, tmp_path):
    rows = [(i, float(i % 7) if i % 5 else None, "xyz"[i % 3] if i % 4 else None, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, n double, t string, label int")
    p = T.FeaturePipeline(keep=["id"], with_interactions=True).fit(df, "label")
    p.save(spark, str(tmp_path / "p"))
    again = T.FeaturePipeline.load(spark, str(tmp_path / "p"))
    assert p.transform(df).orderBy("id").collect() == again.transform(df).orderBy("id").collect()
    unseen = spark.createDataFrame([(1, 2.0, "new", 0)], df.schema)
    assert all(p.transform(unseen).first()[c] == 0.0 for c in p.output_columns() if c.startswith("t_"))


def test_pipeline_names_and_temporal_stage(spark, tmp_path):
    import datetime

    rows = [(i % 6, datetime.datetime(2024, 1, 1 + i % 28), float(i % 7), float(i % 5 + 1), "xyz"[i % 3], i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "customer_id long, at timestamp_ntz, max_x_pos double, b_div_c double, t string, label int")
    assert T.infer_transaction_columns(df).value == "max_x_pos"  # no value-like name: the first other number
    p = T.FeaturePipeline(with_interactions=True, with_temporal=True).fit(df, "label")
    out = p.transform(df)
    assert {"max_x_pos_x_b_div_c", "rfm_frequency", "rfm_recency_days", "customer_id", "at"} <= set(out.columns)
    # customers keep their ids, figures are scaled like other numbers, products are of the scaled columns
    assert {r[0] for r in out.select("customer_id").distinct().collect()} == set(range(6)) and out.count() == 80
    mean, sd, wrong = out.agg(F.avg("rfm_frequency"), F.stddev_pop("rfm_frequency"), F.max(F.abs(F.col("max_x_pos_x_b_div_c") - F.col("max_x_pos") * F.col("b_div_c")))).first()
    assert abs(mean) < 1e-9 and abs(sd - 1) < 1e-9 and wrong == 0
    p.save(spark, str(tmp_path / "t"))
    again = T.FeaturePipeline.load(spark, str(tmp_path / "t")).transform(df)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, again.collect()))


def test_pca_is_centred_and_ordered(table):
    out = T.apply_pca(table, T.fit_pca(table, ["a", "b"], 2)).agg(F.avg("pc1"), F.var_pop("pc1"), F.var_pop("pc2")).first()
    assert abs(out[0]) < 1e-9 and out[1] >= out[2]


def test_transaction_columns_by_name(spark):
    df = spark.createDataFrame([], "customer_id string, d timestamp, amount double")
    assert T.infer_transaction_columns(df).value == "amount"
    assert T.infer_transaction_columns(df.drop("d")) is None


def test_kmeans_and_ward_find_blobs(spark):
    rng = random.Random(2)
    rows = [(i, rng.gauss(10 * (i % 3), 0.5), rng.gauss(-10 * (i % 3), 0.5)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    for seg in (G.kmeans_segments(df, "id", ["x", "y"], 3, restarts=3), G.hierarchical_segments(df, "id", ["x", "y"], 3, micro=12)):
        groups = {}
        for r in seg.collect():
            groups.setdefault(r["segment"], set()).add(r["id"] % 3)
        assert len(groups) == 3 and all(len(g) == 1 for g in groups.values())
    best = G.choose_k(df, "id", ["x", "y"], max_clusters=5).where("best").first()
    assert best["n_clusters"] == 3
    with pytest.raises(ValueError):
        G.choose_k(df.limit(5), "id", ["x", "y"])


def test_log_gamma_and_series():
    x = np.array([0.1, 0.5, 1.0, 3.7, 25.0])
    assert np.allclose(V.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)
    # 2F1(1, 1; 2; z) = -ln(1 - z) / z
    z = np.array([0.1, 0.6, 0.95])
    one = np.ones(3)
    assert np.allclose(V._hyp2f1(one, one, 2 * one, z), -np.log(1 - z) / z)


def test_bgnbd_recovers_simulated_parameters(spark):
    rng = np.random.default_rng(7)
    n, T_end = 4000, 60.0
    lam, p = rng.gamma(2.0, 1 / 10.0, n), rng.beta(1.5, 4.0, n)
    rows = []
    for i in range(n):
        t, x, last = 0.0, 0, 0.0
        while True:
            t += rng.exponential(1 / lam[i])
            if t > T_end:
                break
            x, last = x + 1, t
            if rng.random() < p[i]:
                break
        rows.append((i, x, float(last), T_end))
    s = spark.createDataFrame(rows, "customer_id long, frequency long, recency double, T double")
    fit = V.fit_bgnbd(s, penalty=0.0)
    r, alpha, a, b = fit.params
    assert r / alpha == pytest.approx(0.2, rel=0.1) and a / (a + b) == pytest.approx(1.5 / 5.5, rel=0.15)
    # the likelihood at the fit beats the truth
    arr = np.array([(x, t, T) for _, x, t, T in rows])
    assert fit.log_likelihood >= V.bgnbd_terms((2.0, 10.0, 1.5, 4.0), arr[:, 0], arr[:, 1], arr[:, 2]).sum()
    out = V.predict_clv(s.withColumn("monetary_value", F.lit(10.0)), "customer_id", fit, None).agg(F.min("predicted_clv"), F.count("predicted_clv")).first()
    assert out[0] >= 0 and out[1] == n


def test_gamma_gamma_shrinks_to_the_population(spark):
    rng = np.random.default_rng(1)
    nu = rng.gamma(4.0, 1 / 20.0, 1500)
    rows = []
    for i in range(1500):
        x = int(rng.integers(1, 9))
        rows.append((i, x, float(rng.gamma(6.0, 1 / nu[i], x).mean())))
    s = spark.createDataFrame(rows, "id long, frequency long, monetary_value double")
    p, q, v = V.fit_gamma_gamma(s, penalty=0.0).params
    assert v * p / (q - 1) == pytest.approx(np.mean([r[2] for r in rows]), rel=0.1)
    assert V.fit_gamma_gamma(s.where("frequency > 99")) is None


def linear_score(df):
    return df.withColumn("score", 2 * F.col("a") - F.col("b") + 0.5)


def test_shapley_is_additive_and_exact_for_linear_models(table):
    back = [{"a": 0.0, "b": 1.0}, {"a": 1.0, "b": -1.0}]
    got = {(r["id"], r["feature"]): r["contribution"] for r in X.shapley_attributions(table, "id", ["a", "b"], linear_score, back, 8).collect()}
    rng_mean = None
    for r in table.collect():
        total = got[r["id"], "a"] + got[r["id"], "b"]
        base = 2 * r["a"] - r["b"] + 0.5 - total
        rng_mean = base if rng_mean is None else rng_mean
        assert base == pytest.approx(rng_mean)  # one and the same mean background score


def test_interactions_vanish_for_linear_models(table):
    back = [{"a": 0.0, "b": 1.0}]
    assert X.interaction_strengths(table, "id", ["a", "b"], linear_score, back).first()["strength"] == pytest.approx(0, abs=1e-9)
    prod = X.interaction_strengths(table, "id", ["a", "b"], lambda d: d.withColumn("score", F.col("a") * F.col("b")), back)
    assert prod.first()["strength"] > 0.1


def test_partial_dependence_of_a_line(table):
    rows = X.partial_dependence(table, ["a", "b"], linear_score, ["a"], points=5).orderBy("grid_value").collect()
    slope = (rows[-1]["mean_score"] - rows[0]["mean_score"]) / (rows[-1]["grid_value"] - rows[0]["grid_value"])
    assert slope == pytest.approx(2.0)


def test_surrogate_signs_and_repeatability(table):
    small = table.limit(20).cache()
    got = X.local_surrogate(small, "id", ["a", "b"], linear_score, samples=60).collect()
    assert all((r["contribution"] > 0) == (r["feature"] == "a") for r in got) and len(got) == 40
    assert sorted(got) == sorted(X.local_surrogate(small.repartition(3), "id", ["a", "b"], linear_score, samples=60).collect())


def test_isolation_forest_flags_the_far_points(spark):
    rng = random.Random(0)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(190)] + [(190 + i, 30.0 + i, -30.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    out = isolation_outliers(df, "id", ["x", "y"], trees=30)
    flagged = {r["id"] for r in out.where("is_outlier").collect()}
    assert {190 + i for i in range(10)} <= flagged and len(flagged) <= 20


def test_calibration_methods_share_base_models(spark):
    from retenta.operators import models

    rows = [(i, float(i * 7919 % 13 > i % 9), float(i % 9)) for i in range(90)]
    df = models.assemble(spark.createDataFrame(rows, "id long, label double, x double"), ["x"], ["id", "label"])

    class Counting:
        fits = 0

        def fit(self, rows):
            Counting.fits += 1
            return models.logistic(90).fit(rows)

    out = models.compare_calibrations(Counting(), df, "id").collect()
    assert {r["method"] for r in out} == {"uncalibrated", "isotonic", "sigmoid"} and Counting.fits == 4


def test_clustering_takes_no_more_tasks_than_cores(spark):
    from retenta.operators import segments

    df = spark.range(4000).select("id", (F.col("id") % 97).cast("double").alias("x"), F.rand(1).alias("y")).repartition(20)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        assert segments.standardised(df, "id", ["x", "y"]).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
