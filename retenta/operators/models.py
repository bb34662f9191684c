"""Training, cross-validation, calibration, scoring and the model registry, on Spark ML."""

from __future__ import annotations

import itertools
import random
import uuid
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StructType

from retenta.functions.expr import hash_key, hash_uniform
from retenta.operators.commits import commit, read_commits
from retenta.operators.splits import stratified_folds
from retenta.plans.isotonic import Isotonic, apply_isotonic, fit_isotonic
from retenta.plans.order import number_rows
from retenta.plans.scoretable import calibration_bins, calibration_errors, join_groups, metric_set
from retenta.session import settle


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Vector column at the ML boundary; only the needed columns travel on."""
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return out.select(*keep, "features")


def majority_class(df: DataFrame, label: str = "label") -> DataFrame:
    """Constant prediction: the most frequent class (smallest on ties) with probability 1."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("k"))
    best = counts.agg(F.max_by(label, F.struct(F.col("k"), -F.col(label)))).scalar()
    return df.withColumn("prediction", best).withColumn("score", (F.col("prediction") == 1).cast("double"))


def stratified_guess(df: DataFrame, ident: str, label: str = "label", seed: int = 42) -> DataFrame:
    """Random class by the class prior, reproducible per id."""
    prior = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    return df.withColumn("prediction", (hash_uniform(hash_key(seed, F.col(ident))) < prior).cast("int"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, weight): n / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    return counts.withColumn("t", total).select(label, "n", (F.col("t.n") / (F.col("t.k") * F.col("n"))).alias("weight"))


def with_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Class sizes are a handful of values, so they travel as literals."""
    found = {r[label]: r["weight"] for r in class_weights(df, label).collect()}
    w = F.lit(None).cast("double")
    for value, weight in found.items():
        w = F.when(F.col(label) == value, F.lit(weight)).otherwise(w)
    return df.withColumn("weight", w)


def logistic(n_rows: int, c: float = 1.0, balanced: bool = False, label: str = "label") -> LogisticRegression:
    """L2 logistic regression: penalty 1 / (C n) on the mean loss, coefficients not rescaled."""
    est = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (c * n_rows), standardization=False,
                             maxIter=200, tol=1e-7)
    return est.setWeightCol("weight") if balanced else est


# fixed values: the forest search space (depth None is the library maximum of 30)
FOREST_GRID = {"numTrees": [100, 200, 300], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 4]}
# fixed values: the boosting search space
BOOST_GRID = {"maxIter": [100, 200, 300], "maxDepth": [3, 6, 10], "stepSize": [0.01, 0.1, 0.2], "subsamplingRate": [0.8, 0.9, 1.0]}


def forest(label: str = "label", weighted: bool = False, **params) -> RandomForestClassifier:
    est = RandomForestClassifier(featuresCol="features", labelCol=label, seed=42, **params)
    return est.setWeightCol("weight") if weighted else est


def boosted(label: str = "label", weighted: bool = True, **params) -> GBTClassifier:
    """Boosted trees; `weight` carries the class imbalance."""
    est = GBTClassifier(featuresCol="features", labelCol=label, seed=42, **params)
    return est.setWeightCol("weight") if weighted else est


def random_search(est: Estimator, grid: dict[str, Sequence], df: DataFrame, ident: str, label: str = "label",
                  draws: int | None = None, folds: int = 5, seed: int = 42, parallelism: int = 4):
    """Best model by ROC-AUC over random grid points (default: as many draws as parameters), k stratified folds.

    The folds are kept while the fits run, since each fit reads them several times.  Trees are drawn by
    partition, so the best point is fitted on the rows as they come when they are not kept.
    """
    points = list(itertools.product(*grid.values()))
    chosen = random.Random(seed).sample(points, min(len(points), draws or min(50, len(grid))))
    maps = [{est.getParam(name): v for name, v in zip(grid, p)} for p in chosen]
    folded = stratified_folds(df, ident, label, folds, seed)
    ranked = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", numBins=0)
    found = []
    folded.persist()
    try:
        for k in range(folds):
            learn, held = folded.where(F.col("fold") != k).persist(), folded.where(F.col("fold") == k).persist()
            if learn.isEmpty() or held.isEmpty():
                raise ValueError(f"fold {k} has no rows, or all of them")
            one = inheritable_thread_target(df.sparkSession)(lambda m: ranked.evaluate(est.fit(learn, m).transform(held, m)))
            with ThreadPool(min(parallelism, len(maps))) as pool:
                found.append(pool.map(one, maps))
            learn.unpersist()
            held.unpersist()
    finally:
        folded.unpersist()
    mean = np.mean(found, axis=0)
    return CrossValidatorModel(est.fit(folded, maps[int(mean.argmax())]), mean.tolist(), [], np.std(found, axis=0).tolist())


def score_with(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """`keep` columns plus `score`, the probability of class 1."""
    return model.transform(df).select(*keep, F.get(vector_to_array("probability"), 1).alias("score"))


def out_of_fold(est: Estimator, df: DataFrame, ident: str, label: str = "label", folds: int = 5, seed: int = 42) -> DataFrame:
    """(id, label, fold, score): every row scored by the model that did not see it.

    The loop runs over the k folds, not over data; each turn is one fit on the cluster.
    """
    folded = settle(stratified_folds(df, ident, label, folds, seed), "folds")
    parts = [score_with(est.fit(folded.where(F.col("fold") != k)), folded.where(F.col("fold") == k), [ident, label, "fold"])
             for k in range(folds)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SCORING = {"roc_auc": "roc_auc", "average_precision": "pr_auc", "accuracy": "accuracy", "precision": "precision", "recall": "recall", "f1": "f1"}


def cross_validate(est: Estimator, df: DataFrame, ident: str, label: str = "label", folds: int = 5, seed: int = 42) -> DataFrame:
    """(metric, mean, std): fold metrics in one grouped pass, population deviation."""
    scored = settle(out_of_fold(est, df, ident, label, folds, seed), "oof")
    return summarise_folds(metric_set(scored, ["fold"], label=label))


def summarise_folds(fold_metrics: DataFrame) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(c).alias("v")) for k, c in SCORING.items()])
    return fold_metrics.select(F.explode(cells).alias("m")).groupBy(F.col("m.metric").alias("metric")).agg(
        F.avg("m.v").alias("mean"), F.stddev_pop("m.v").alias("std"))


def comparison_table(results: DataFrame, by: str = "roc_auc") -> DataFrame:
    """(model, metric, mean, std) rows pivoted to one row per model, best first."""
    wide = results.groupBy("model").pivot("metric", list(SCORING)).agg(F.first("mean"))
    return wide.orderBy(F.col(by).desc_nulls_last(), "model")


def best_model(table: DataFrame, metric: str = "roc_auc") -> DataFrame:
    return table.orderBy(F.col(metric).desc_nulls_last(), "model").limit(1).select("model", metric)


def data_fingerprint(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """16 hex digits from the shape and the rounded sums, equal for equal data in any order."""
    parts = [F.count(F.lit(1)).cast("string"), F.lit(str(len(features)))]
    for c in (*features, label):
        parts.append(F.coalesce(F.sum(F.round(F.col(c).cast("double") * 100).cast("long")).cast("string"), F.lit("null")))
    return df.agg(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 16).alias("fingerprint"))


def risk_band(score: Column, low: float = 0.3, high: float = 0.7) -> Column:
    """Right-closed bands (0, low], (low, high], (high, 1]; a score of 0 has no band."""
    return F.when((score > 0) & (score <= low), "Low").when((score > low) & (score <= high), "Medium").when(
        (score > high) & (score <= 1), "High")


def batch_score(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    out = score_with(model, df, keep).withColumnRenamed("score", "churn_probability")
    return out.withColumn("risk_level", risk_band(F.col("churn_probability")))


# calibration


def _calibrator(held: DataFrame, method: str, label: str) -> Model | Isotonic:
    if method == "isotonic":
        return fit_isotonic(held, "score", label)
    counts = held.agg(F.sum(F.col(label).cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    up, down = (counts["p"] + 1) / (counts["p"] + 2), 1 / (counts["n"] - counts["p"] + 2)
    target = F.when(F.col(label) == 1, F.lit(up)).otherwise(F.lit(down))
    soft = F.array(F.struct(F.lit(1.0).alias("y"), target.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - target).alias("w")))
    rows = held.select(_logit(F.col("score")).alias("x"), F.explode(soft).alias("s")).groupBy("x", "s.y").agg(F.sum("s.w").alias("w"))
    return LogisticRegression(featuresCol="features", labelCol="y", weightCol="w", standardization=False, maxIter=200, tol=1e-7).fit(
        VectorAssembler(inputCols=["x"], outputCol="features").transform(rows))


def _logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    return F.ln(safe / (1 - safe))


def _calibrated(model: Model | Isotonic, df: DataFrame, method: str, name: str) -> DataFrame:
    if method == "isotonic":
        return apply_isotonic(df, model, "score", name)
    x = VectorAssembler(inputCols=["_x"], outputCol="features").transform(df.withColumn("_x", _logit(F.col("score"))))
    out = model.transform(x)
    return out.withColumn(name, F.get(vector_to_array("probability"), 1)).drop("_x", "features", "rawPrediction", "probability", "prediction")


class Calibrated:
    """Base and calibrator per fold; the score is the mean over folds."""

    def __init__(self, pairs: list[tuple[Model, Model]], method: str) -> None:
        self.pairs, self.method = pairs, method

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        out, names = df, []
        for i, (base, cal) in enumerate(self.pairs):
            scored = base.transform(out).withColumn("score", F.get(vector_to_array("probability"), 1)).drop(
                "rawPrediction", "probability", "prediction")
            held = scored.withColumnRenamed("features", "_f")
            out = _calibrated(cal, held, self.method, f"_p{i}").drop("score").withColumnRenamed("_f", "features")
            names.append(f"_p{i}")
        total = F.col(names[0])
        for n in names[1:]:
            total = total + F.col(n)
        return out.select(*keep, (total / len(names)).alias("score"))


def _fold_bases(est: Estimator, df: DataFrame, ident: str, label: str, folds: int, seed: int = 42) -> list[tuple[Model, DataFrame]]:
    """Per fold: base model on the rest, and the scores it gives the fold."""
    folded = settle(stratified_folds(df, ident, label, folds, seed), "folds")
    bases = [est.fit(folded.where(F.col("fold") != k)) for k in range(folds)]
    return [(base, score_with(base, folded.where(F.col("fold") == k), [label])) for k, base in enumerate(bases)]


def calibrate(est: Estimator, df: DataFrame, ident: str, method: str = "isotonic", label: str = "label", folds: int = 3,
              seed: int = 42) -> Calibrated:
    """Per fold: base model on the rest, isotonic or sigmoid calibrator on the held-out scores."""
    return Calibrated([(base, _calibrator(held, method, label)) for base, held in _fold_bases(est, df, ident, label, folds, seed)], method)


def calibration_quality(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Brier, log loss, ECE and MCE per group."""
    m = metric_set(scored, by).select(*by, "brier_score", "log_loss")
    return join_groups(m, calibration_errors(calibration_bins(scored, by), by).select(*by, "ece", "mce"), by)


def compare_calibrations(est: Estimator, df: DataFrame, ident: str, label: str = "label", folds: int = 3) -> DataFrame:
    """Uncalibrated, isotonic and sigmoid on the training rows, best Brier first; both methods share the folds' base models."""
    keep = [ident, label]
    bases = _fold_bases(est, df, ident, label, folds)
    parts = [score_with(est.fit(df), df, keep).withColumn("method", F.lit("uncalibrated"))]
    for m in ("isotonic", "sigmoid"):
        fitted = Calibrated([(base, _calibrator(held, m, label)) for base, held in bases], m)
        parts.append(fitted.score(df, keep).withColumn("method", F.lit(m)))
    all_rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return calibration_quality(settle(all_rows, "calibrations"), ["method"]).orderBy("brier_score", "method")


# registry: metadata tables that grow by commits.
# models: (model_id, model_name, model_type, version, stage, experiment_id, tags, metrics map)

REGISTRY_SCHEMA = ("model_id string, model_name string, model_type string, version int, stage string, experiment_id string, "
                   "tags array<string>, metrics map<string,double>")


EXPERIMENT_SCHEMA = "experiment_id string, experiment string, models map<string,string>, config map<string,string>, results map<string,double>"
MODEL_KEYS, EXPERIMENT_KEYS = ["model_name", "version"], ["experiment_id"]


def registered(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The registry's models as of a commit (default: the newest)."""
    return read_commits(spark, f"{path}/models", _schema(REGISTRY_SCHEMA), MODEL_KEYS, upto)


def registered_experiments(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    return read_commits(spark, f"{path}/experiments", _schema(EXPERIMENT_SCHEMA), EXPERIMENT_KEYS, upto)


def _schema(text: str) -> StructType:
    return StructType.fromDDL(text)


def register_models(path: str, new: DataFrame, order: Sequence[str]) -> int:
    """Add models in one commit; returns its number.

    `new` has the columns of REGISTRY_SCHEMA but for `version`, which continues
    each name's versions along `order`, and optionally `model_id` and `stage`
    (default `<name>_v<version>` and `registered`).  Names must not be NULL.
    """
    def change(current: DataFrame) -> DataFrame:
        numbered = number_rows(new, list(order), ["model_name"], "_nth").join(next_versions(current), "model_name", "left")
        rows = numbered.withColumn("version", (F.coalesce("next_version", F.lit(1)) + F.col("_nth") - 1).cast("int"))
        given = {"model_id": F.concat("model_name", F.lit("_v"), F.col("version")), "stage": F.lit("registered")}
        return rows.withColumns({c: F.coalesce(F.col(c), v) if c in rows.columns else v for c, v in given.items()})

    return commit(new.sparkSession, f"{path}/models", _schema(REGISTRY_SCHEMA), MODEL_KEYS, change)


def register_model(spark: SparkSession, path: str, model: Model, name: str, kind: str, metrics: dict[str, float],
                   experiment_id: str | None = None, tags: Sequence[str] = ()) -> str:
    """Save a fitted model and add it to the registry; returns the folder of the model.

    The model is written before its row, so a registered model is always whole.
    The folder is a tag `path:<folder>` of the row.
    """
    folder = f"{path}/artifacts/{uuid.uuid4().hex}"
    save_model(model, folder)
    row = (name, kind, experiment_id, [*tags, f"path:{folder}"], {k: float(v) for k, v in metrics.items()})
    schema = "model_name string, model_type string, experiment_id string, tags array<string>, metrics map<string,double>"
    register_models(path, spark.createDataFrame([row], schema), ["model_type"])
    return folder


def register_experiments(path: str, new: DataFrame) -> int:
    """Add or replace experiments (columns of EXPERIMENT_SCHEMA) in one commit; one row per id."""
    return commit(new.sparkSession, f"{path}/experiments", _schema(EXPERIMENT_SCHEMA), EXPERIMENT_KEYS, lambda current: new)


def commit_promotion(spark: SparkSession, path: str, model_id: str, stage: str = "production") -> int:
    """`promote` as a commit of the rows whose stage changes."""
    def change(current: DataFrame) -> DataFrame:
        return promote(current.withColumn("_was", F.col("stage")), model_id, stage).where(~F.col("stage").eqNullSafe(F.col("_was")))

    return commit(spark, f"{path}/models", _schema(REGISTRY_SCHEMA), MODEL_KEYS, change)


def commit_cleanup(spark: SparkSession, path: str, keep: int = 5) -> int:
    """`cleanup` as a commit that marks the rows it drops; their versions are not given again while newer ones exist."""
    def change(current: DataFrame) -> DataFrame:
        return current.join(cleanup(current, keep).select(*MODEL_KEYS), MODEL_KEYS, "left_anti").withColumn("deleted", F.lit(True))

    return commit(spark, f"{path}/models", _schema(REGISTRY_SCHEMA), MODEL_KEYS, change)


def list_models(models: DataFrame, name: str | None = None, kind: str | None = None, tags: Sequence[str] = ()) -> DataFrame:
    """Models by name, type and any of the tags, newest version first."""
    out = models
    if name:
        out = out.where(F.col("model_name") == name)
    if kind:
        out = out.where(F.col("model_type") == kind)
    if tags:
        out = out.where(F.arrays_overlap("tags", F.array(*[F.lit(x) for x in tags])))
    return out.orderBy("model_name", F.col("version").desc())


def compare_models(models: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return models.where(F.col("model_id").isin(*ids)).select(
        "model_id", "model_name", "version", *[F.col("metrics")[m].alias(m) for m in metrics])


def best_registered(models: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """Best model id per name by a metric; the newest version wins ties."""
    m = models.withColumn("value", F.col("metrics")[metric]).where(F.col("value").isNotNull())
    best = F.max_by(F.struct("model_id", "version", "value"), F.struct("value", "version")).alias("b")
    return m.groupBy("model_name").agg(best).select("model_name", "b.*")


def next_versions(models: DataFrame) -> DataFrame:
    return models.groupBy("model_name").agg((F.max("version") + 1).alias("next_version"))


def promote(models: DataFrame, model_id: str, stage: str = "production") -> DataFrame:
    """The model gets the stage; others of the same name that held it become archived."""
    name = models.where(F.col("model_id") == model_id).agg(F.max("model_name")).scalar()
    new = F.when(F.col("model_id") == model_id, F.lit(stage)).when(
        (F.col("model_name") == name) & (F.col("stage") == stage), F.lit("archived")).otherwise(F.col("stage"))
    return models.withColumn("stage", new)


def delete_model(models: DataFrame, model_id: str, force: bool = False) -> DataFrame:
    """Without the row; a production model only goes with force."""
    keep = F.col("model_id") != model_id
    return models.where(keep if force else keep | (F.col("stage") == "production"))


def cleanup(models: DataFrame, keep: int = 5) -> DataFrame:
    """The newest `keep` versions per name, and production always.

    The limit stands alone behind the rank, so each task passes on no more than
    `keep` rows of a name.
    """
    order = W.partitionBy("model_name").orderBy(F.col("version").desc())
    newest = models.select("model_name", "version").withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= keep)
    kept = newest.select("model_name", "version", F.lit(True).alias("_new")).distinct()
    return models.join(kept, ["model_name", "version"], "left").where(F.col("_new") | (F.col("stage") == "production")).drop("_new")


def lineage(models: DataFrame, experiments: DataFrame) -> DataFrame:
    """Models with their experiment; models without one keep NULLs."""
    return models.join(experiments, "experiment_id", "left")


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)
