"""Commits of the model registry: versions of concurrent writers, whole snapshots, promotion and clean-up."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import Vectors

from retenta.operators import commits, models as M

NEW = "model_name string, model_type string, experiment_id string, tags array<string>, metrics map<string,double>, nth int"


def batch(spark, name, count, start=0):
    return spark.createDataFrame([(name, "tree", None, [], {"roc_auc": 0.5 + i / 100}, i) for i in range(start, start + count)], NEW)


def test_versions_continue(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert M.registered(spark, path).count() == 0
    assert M.register_models(path, batch(spark, "a", 2), ["nth"]) == 1
    assert M.register_models(path, batch(spark, "a", 1).unionByName(batch(spark, "b", 1)), ["nth"]) == 2
    got = sorted((r["model_id"], r["version"], r["stage"]) for r in M.registered(spark, path).collect())
    assert got == [("a_v1", 1, "registered"), ("a_v2", 2, "registered"), ("a_v3", 3, "registered"), ("b_v1", 1, "registered")]
    assert M.registered(spark, path, upto=1).count() == 2


def test_two_writers_get_different_versions(spark, tmp_path):
    path = str(tmp_path / "registry")
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: M.register_models(path, batch(spark, "a", 1, i), ["nth"]), range(4)))
    assert sorted(numbers) == [1, 2, 3, 4]
    assert sorted(r["version"] for r in M.registered(spark, path).collect()) == [1, 2, 3, 4]
    assert not list((tmp_path / "registry" / "models" / "_work").glob("_*"))


def test_the_loser_of_a_number_tries_again(spark, tmp_path):
    path, seen = str(tmp_path / "registry"), []

    def slow(current):
        seen.append(current.count())
        if len(seen) == 1:
            M.register_models(path, batch(spark, "a", 2), ["nth"])
        return current.limit(0)

    schema = M.registered(spark, path).schema
    assert commits.commit(spark, f"{path}/models", schema, M.MODEL_KEYS, slow) == 2
    assert seen == [0, 2] and M.registered(spark, path).count() == 2


def test_a_reader_keeps_its_snapshot(spark, tmp_path):
    path = str(tmp_path / "registry")
    M.register_models(path, batch(spark, "a", 1), ["nth"])
    before = M.registered(spark, path)
    M.register_models(path, batch(spark, "a", 5), ["nth"])
    assert before.count() == 1 and M.registered(spark, path).count() == 6


def test_promotion_and_cleanup(spark, tmp_path):
    path = str(tmp_path / "registry")
    M.register_models(path, batch(spark, "a", 8), ["nth"])
    M.commit_promotion(spark, path, "a_v1")
    M.commit_promotion(spark, path, "a_v2")
    stages = {r["model_id"]: r["stage"] for r in M.registered(spark, path).collect()}
    assert stages["a_v1"] == "archived" and stages["a_v2"] == "production" and stages["a_v3"] == "registered"
    M.commit_cleanup(spark, path, keep=3)
    assert sorted(r["version"] for r in M.registered(spark, path).collect()) == [2, 6, 7, 8]
    M.register_models(path, batch(spark, "a", 1), ["nth"])
    assert M.registered(spark, path).agg({"version": "max"}).first()[0] == 9


def test_a_fitted_model_comes_back(spark, tmp_path):
    path = str(tmp_path / "registry")
    df = spark.createDataFrame([(Vectors.dense([float(i)]), float(i > 5)) for i in range(12)], ["features", "label"])
    model = LogisticRegression(regParam=0.1).fit(df)
    folder = M.register_model(spark, path, model, "churn", "logistic", {"roc_auc": 1.0}, tags=["test"])
    row = M.registered(spark, path).first()
    assert row["version"] == 1 and row["tags"] == ["test", f"path:{folder}"] and row["metrics"] == {"roc_auc": 1.0}
    assert LogisticRegressionModel.load(folder).coefficients == model.coefficients


def test_experiments_replace_by_id(spark, tmp_path):
    path = str(tmp_path / "registry")
    for auc in (0.6, 0.7):
        M.register_experiments(path, spark.createDataFrame([("e1", "first", {"tree": "a_v1"}, {"folds": "5"}, {"roc_auc": auc})], M.EXPERIMENT_SCHEMA))
    (row,) = M.registered_experiments(spark, path).collect()
    assert row["results"] == {"roc_auc": 0.7} and row["models"] == {"tree": "a_v1"}
