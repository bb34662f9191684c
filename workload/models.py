"""Training, calibration, scoring and registry queries over customers."""

import uuid

from pyspark.sql import functions as F

from retenta.operators import boosting as B
from retenta.operators import models as M
from retenta.operators import transform as X
from retenta.plans.isotonic import apply_isotonic, fit_isotonic
from retenta.plans.scoretable import metric_set
from retenta.session import keep, settle, work_folder
from workload.base import SCORED_SQL, TWO_MODELS_SQL, scored, two_models
from workload.business import METRICS_SQL
from workload.registry import query

WITH = "WITH " + SCORED_SQL
FEATURES = ["frequency", "monetary", "balance"]


def training(t):
    """Scaled features as a vector, settled once: every fit reads it several times."""
    s = keep(scored(t).select("customer_id", "label", *FEATURES))  # the scaling's passes share one aggregation of the orders
    scaled = X.apply_numeric(s, X.fit_numeric(s, FEATURES)).withColumn("label", F.col("label").cast("double"))
    out = settle(M.assemble(scaled, FEATURES, ["customer_id", "label"]), "training")
    s.unpersist()
    return out


@query("majority_class", WITH + """, c AS (SELECT label AS best FROM scored GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT customer_id, best AS prediction FROM scored, c""", whole="prediction")
def majority_class(t):
    return M.majority_class(scored(t)).select("customer_id", "prediction")


@query("stratified_guess", WITH + """, p AS (SELECT avg(label) AS prior FROM scored)
SELECT customer_id, CASE WHEN ('0x' || substr(md5('42|' || customer_id), 1, 8))::BIGINT / 4294967296e0 < prior THEN 1 ELSE 0 END AS prediction FROM scored, p""", whole="prediction")
def stratified_guess(t):
    return M.stratified_guess(scored(t), "customer_id").select("customer_id", "prediction")


@query("class_weights", WITH + "SELECT label, count(*) AS n, (SELECT count(*) FROM scored) / (2e0 * count(*)) AS weight FROM scored GROUP BY label", real="weight", whole="n")
def class_weights(t):
    return M.class_weights(scored(t))


@query("logistic_scores")
def logistic_scores(t):
    df = training(t)
    model = M.logistic(df.count()).fit(df)
    return M.batch_score(model, df, ["customer_id", "label"])


@query("logistic_balanced_scores")
def logistic_balanced_scores(t):
    df = M.with_weights(training(t))
    return M.batch_score(M.logistic(df.count(), balanced=True).fit(df), df, ["customer_id", "label"])


@query("forest_search")
def forest_search(t):
    df = training(t)
    best = M.random_search(M.forest(), {"numTrees": [10, 20], "maxDepth": [3, 5]}, df, "customer_id", folds=3)
    return M.batch_score(best.bestModel, df, ["customer_id", "label"])


@query("boosted_scores")
def boosted_scores(t):
    df = M.with_weights(training(t))
    return M.batch_score(M.boosted(maxIter=5, maxDepth=3).fit(df), df, ["customer_id", "label"])


@query("boosted_trees")
def boosted_trees(t):
    """Second-order boosting, 100 trees of depth 3 (the first point of the search space), classes balanced."""
    s = settle(scored(t).select("customer_id", "label", *FEATURES), "boosted")
    model = B.boost(s, "customer_id", FEATURES, trees=100, depth=3, eta=0.1)
    return model.score(s, ["customer_id", "label"]).withColumn("risk_level", M.risk_band(F.col("score")))


def _side(name, rows):
    """Best split of a node's rows in SQL: gains of every cut, ties as in the fit."""
    return f"""
cand_{name} AS (
  SELECT c.feature, c.cut, sum(g) FILTER (x <= cut) AS gl, sum(h) FILTER (x <= cut) AS hl, sum(g) AS g, sum(h) AS h
  FROM {rows} r JOIN cuts c USING (feature) GROUP BY c.feature, c.cut HAVING count(*) FILTER (x <= cut) > 0 AND count(*) FILTER (x > cut) > 0
),
best_{name} AS (
  SELECT *, (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2 AS gain FROM cand_{name}
  WHERE hl >= 1 AND h - hl >= 1 ORDER BY round((gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2, 9) DESC, feature, cut LIMIT 1
)"""


FIRST_TREE = WITH + """,
k AS (SELECT count(*) FILTER (label = 0) / count(*) FILTER (label = 1)::DOUBLE AS weight FROM scored),
gh AS (SELECT *, (5e-1 - label) * CASE WHEN label = 1 THEN weight ELSE 1e0 END AS g, 25e-2 * CASE WHEN label = 1 THEN weight ELSE 1e0 END AS h FROM scored, k),
long AS (""" + " UNION ALL ".join(f"SELECT customer_id, {i} AS feature, {c}::DOUBLE AS x, g, h FROM gh" for i, c in enumerate(FEATURES)) + """),
cuts AS (
  SELECT DISTINCT feature, cut FROM (
    SELECT feature, unnest(quantile_cont(x, [""" + ", ".join(repr(i / 32) for i in range(1, 32)) + """])) AS cut, max(x) AS top FROM long GROUP BY feature)
  WHERE cut < top
),""" + _side("root", "long") + """,
sided AS (SELECT l.*, s.low FROM long l JOIN (SELECT customer_id, x <= cut AS low FROM long JOIN best_root USING (feature)) s USING (customer_id)),
lefts AS (SELECT * FROM sided WHERE low), rights AS (SELECT * FROM sided WHERE NOT low),""" + _side("left", "lefts") + "," + _side("right", "rights") + """
SELECT 0 AS node, feature, cut AS threshold, gain, -1e-1 * gl / (hl + 1) AS low_value, -1e-1 * (g - gl) / (h - hl + 1) AS high_value FROM best_root
UNION ALL SELECT 1, feature, cut, gain, -1e-1 * gl / (hl + 1), -1e-1 * (g - gl) / (h - hl + 1) FROM best_left
UNION ALL SELECT 2, feature, cut, gain, -1e-1 * gl / (hl + 1), -1e-1 * (g - gl) / (h - hl + 1) FROM best_right"""


@query("boosting_first_tree", FIRST_TREE, real="threshold gain low_value high_value", whole="node feature")
def boosting_first_tree(t):
    """The three splits of the first tree of depth 2, and what each side would answer as a leaf."""
    return B.boost(scored(t), "customer_id", FEATURES, trees=1, depth=2, eta=0.1, bins=32).splits(t.spark).drop("tree")


@query("cross_validation")
def cross_validation(t):
    df = training(t)
    return M.cross_validate(M.logistic(df.count()), df, "customer_id", folds=3)


METRICS2 = METRICS_SQL.format(by="model,", src="models", part="PARTITION BY model", group="GROUP BY model", join="JOIN", using="USING (model)")


def _results(t):
    m = metric_set(two_models(t), ["model"])
    cells = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(c).alias("mean")) for k, c in M.SCORING.items()])
    return m.select("model", F.explode(cells).alias("r")).select("model", "r.*")


@query("model_comparison", "WITH " + TWO_MODELS_SQL + METRICS2 + """SELECT model, roc_auc, pr_auc AS average_precision, accuracy, "precision", recall, f1 FROM metrics""",
       real="roc_auc average_precision accuracy precision recall f1")
def model_comparison(t):
    return M.comparison_table(_results(t))


@query("best_model", "WITH " + TWO_MODELS_SQL + METRICS2 + "SELECT model, roc_auc FROM metrics ORDER BY roc_auc DESC LIMIT 1", real="roc_auc")
def best_model(t):
    return M.best_model(M.comparison_table(_results(t)))


@query("data_fingerprint", WITH + """SELECT substr(md5(concat_ws('|', count(*), '2', sum(CAST(round(frequency * 1e2) AS BIGINT)), sum(CAST(round(balance * 1e2) AS BIGINT)), sum(label * 100))), 1, 16) AS fingerprint FROM scored""")
def data_fingerprint(t):
    return M.data_fingerprint(scored(t), ["frequency", "balance"])


@query("risk_bands", WITH + """SELECT customer_id, CASE WHEN score > 0 AND score <= 3e-1 THEN 'Low' WHEN score > 3e-1 AND score <= 7e-1 THEN 'Medium' WHEN score > 7e-1 AND score <= 1 THEN 'High' END AS risk_level FROM scored""")
def risk_bands(t):
    return scored(t).select("customer_id", M.risk_band(F.col("score")).alias("risk_level"))


ISOTONIC = WITH + """,
runs AS (SELECT score, count(*) AS w, sum(label) AS s, row_number() OVER (ORDER BY score) AS i FROM scored GROUP BY score),
upto AS (SELECT score, i, sum(w) OVER (ORDER BY i) AS cw, sum(s) OVER (ORDER BY i) AS cs, w, s FROM runs),
means AS (SELECT a.i AS a, b.i AS b, (b.cs - a.cs + a.s)::DOUBLE / (b.cw - a.cw + a.w) AS m FROM upto a JOIN upto b ON b.i >= a.i),
lowest AS (SELECT a, b, min(m) OVER (PARTITION BY a ORDER BY b DESC) AS m FROM means),
fitted AS (SELECT b AS i, max(m) AS calibrated FROM lowest GROUP BY b)
SELECT customer_id, score, calibrated FROM scored JOIN runs USING (score) JOIN fitted USING (i)"""


@query("isotonic_calibration", ISOTONIC, real="score calibrated", digits=9)
def isotonic_calibration(t):
    """The score's increasing least-squares fit to the label, by customer; ranges of 200 scores, so that several are merged."""
    s = scored(t).select("customer_id", "score", "label")
    return apply_isotonic(s, fit_isotonic(s, per_range=200)).select("customer_id", "score", "calibrated")


@query("calibrated_scores")
def calibrated_scores(t):
    df = training(t)
    return M.calibrate(M.logistic(df.count()), df, "customer_id").score(df, ["customer_id", "label"])


@query("calibration_methods")
def calibration_methods(t):
    df = training(t)
    return M.compare_calibrations(M.logistic(df.count()), df, "customer_id")


# registry: one "model" per part, named by its brand, versions in part order


def registry(t):
    from pyspark.sql import Window as W

    p = t.part
    v = F.row_number().over(W.partitionBy("p_brand").orderBy("p_partkey"))
    return p.select(
        F.col("p_partkey").cast("string").alias("model_id"), F.col("p_brand").alias("model_name"), F.col("p_type").alias("model_type"),
        v.alias("version"), F.when(F.col("p_partkey") % 40 == 0, "production").otherwise("staging").alias("stage"),
        (F.col("p_partkey") % 9).cast("string").alias("experiment_id"),
        F.array(F.col("p_size").cast("string")).alias("tags"), F.create_map(F.lit("roc_auc"), F.col("p_retailprice") / 10000.0).alias("metrics"))


REG = """WITH reg AS (SELECT CAST(p_partkey AS VARCHAR) AS model_id, p_brand AS model_name, p_type AS model_type, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS INTEGER) AS version,
  CASE WHEN p_partkey % 40 = 0 THEN 'production' ELSE 'staging' END AS stage, CAST(p_partkey % 9 AS VARCHAR) AS experiment_id, CAST(p_size AS VARCHAR) AS tag, p_retailprice / 10000e0 AS roc_auc FROM part)"""


@query("registry_list", REG + " SELECT model_id, version FROM reg WHERE model_type = (SELECT min(p_type) FROM part) AND tag IN ('1', '2', '3')")
def registry_list(t):
    kind = t.part.agg(F.min("p_type")).first()[0]
    return M.list_models(registry(t), kind=kind, tags=["1", "2", "3"]).select("model_id", "version")


@query("registry_compare", REG + " SELECT model_id, model_name, version, roc_auc FROM reg WHERE model_id IN ('1', '2', '3')", real="roc_auc")
def registry_compare(t):
    return M.compare_models(registry(t), ["1", "2", "3"], ["roc_auc"])


@query("registry_best", REG + " SELECT model_name, model_id, version, roc_auc AS value FROM reg QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY roc_auc DESC, version DESC) = 1", real="value")
def registry_best(t):
    return M.best_registered(registry(t))


@query("registry_next_version", REG + " SELECT model_name, max(version) + 1 AS next_version FROM reg GROUP BY 1", whole="next_version")
def registry_next_version(t):
    return M.next_versions(registry(t))


@query("registry_promote", REG + """ SELECT model_id, CASE WHEN model_id = '7' THEN 'production' WHEN model_name = (SELECT model_name FROM reg WHERE model_id = '7') AND stage = 'production' THEN 'archived' ELSE stage END AS stage FROM reg""")
def registry_promote(t):
    return M.promote(registry(t), "7").select("model_id", "stage")


@query("registry_commits", """WITH steps AS (SELECT p_partkey, p_brand, p_type, p_partkey % 2 AS step FROM part),
  v AS (SELECT *, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY step, p_partkey) AS INTEGER) AS version FROM steps),
  s AS (SELECT *, p_brand || '_v' || version AS model_id, CASE WHEN version = 2 AND p_brand = (SELECT min(p_brand) FROM part) THEN 'production' ELSE 'registered' END AS stage FROM v)
  SELECT model_id, p_brand AS model_name, p_type AS model_type, version, stage FROM s
  QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY version DESC) <= 20 OR stage = 'production'""")
def registry_commits(t):
    """Parts registered in two commits, one of them promoted, old ones cleaned up, all read back from the newest snapshot."""
    path = f"{work_folder(t.spark)}/registry-{uuid.uuid4().hex}"
    base = registry(t)
    for step in (0, 1):
        new = base.where(F.col("model_id").cast("long") % 2 == step).withColumn("nth", F.col("model_id").cast("long")).drop("model_id", "version", "stage")
        M.register_models(path, new, ["nth"])
    first = t.part.agg(F.min("p_brand")).first()[0]
    M.commit_promotion(t.spark, path, f"{first}_v2")
    M.commit_cleanup(t.spark, path, keep=20)
    return M.registered(t.spark, path).select("model_id", "model_name", "model_type", "version", "stage")


@query("registry_cleanup", REG + " SELECT model_id, model_name, version FROM reg QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC) <= 5 OR stage = 'production'")
def registry_cleanup(t):
    return M.cleanup(registry(t)).select("model_id", "model_name", "version")


@query("registry_lineage", REG + " SELECT model_id, r_name AS experiment FROM reg LEFT JOIN region ON experiment_id = CAST(r_regionkey AS VARCHAR)")
def registry_lineage(t):
    e = t.region.select(F.col("r_regionkey").cast("string").alias("experiment_id"), F.col("r_name").alias("experiment"))
    return M.lineage(registry(t), e).select("model_id", "experiment")
