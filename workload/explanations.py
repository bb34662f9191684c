"""Explanation queries on the scored customers, and isolation-forest outliers."""

import numpy as np
from pyspark.sql import functions as F

from retenta.operators import explain as X
from retenta.plans import trees as P
from retenta.operators.isolation import isolation_outliers
from retenta.operators import models as M
from retenta.operators import transform as T
from retenta.session import settle
from workload.base import SCORED_SQL, scored
from workload.models import FEATURES
from workload.registry import query

WITH = "WITH " + SCORED_SQL
WEIGHTS = {"frequency": -0.1, "balance": 0.0001, "monetary": -0.0000002}

ATT = """,
att AS (""" + " UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS feature, {w:.1e} * ({c} - (SELECT avg({c}) FROM scored)) AS contribution FROM scored" for c, w in WEIGHTS.items()) + ")"


def linear(t):
    return X.linear_attributions(scored(t), "customer_id", WEIGHTS)


def scaled(t):
    s = scored(t)
    s = T.apply_numeric(s, T.fit_numeric(s, FEATURES)).withColumn("label", F.col("label").cast("double"))
    return settle(s.select("customer_id", "label", *FEATURES), "explained")


def prepared(t):
    s = scaled(t)
    vec = M.assemble(s, FEATURES, ["customer_id", "label"])
    return s, X.ml_scorer(M.logistic(s.count()).fit(vec), FEATURES)


@query("linear_attributions", WITH + ATT + " SELECT * FROM att", real="contribution")
def linear_attributions(t):
    return linear(t)


@query("global_importance", WITH + ATT + " SELECT feature, avg(abs(contribution)) AS importance FROM att GROUP BY 1", real="importance")
def global_importance(t):
    return X.global_importance(linear(t))


@query("force_rows", WITH + ATT + """, v AS (""" + " UNION ALL ".join(f"SELECT customer_id, '{c}' AS feature, {c}::DOUBLE AS value FROM scored" for c in WEIGHTS) + """)
SELECT customer_id, feature, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) - 1 AS INTEGER) AS position, contribution, value,
  CASE WHEN contribution > 0 THEN 'positive' ELSE 'negative' END AS effect FROM att JOIN v USING (customer_id, feature)""", real="contribution value")
def force_rows(t):
    return X.force_rows(linear(t), scored(t), "customer_id", list(WEIGHTS))


@query("explainer_agreement", WITH + ATT + """,
alt AS (SELECT customer_id, feature, CASE WHEN customer_id % 2 = 0 AND feature = 'balance' THEN contribution / 100 ELSE contribution END AS contribution FROM att),
pa AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) AS k FROM att),
pb AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) AS k FROM alt),
j AS (SELECT m, pa.customer_id, count(pb.feature) AS same, count(*) AS na FROM (VALUES (1), (2), (3)) s(m) JOIN pa ON pa.k <= m LEFT JOIN pb ON pb.customer_id = pa.customer_id AND pb.feature = pa.feature AND pb.k <= m GROUP BY ALL),
s AS (SELECT m, avg(same / (2e0 * na - same)) AS v FROM j GROUP BY 1)
SELECT (SELECT count(*) FROM scored) AS n, max(v) FILTER (m = 1) AS top_1_agreement, max(v) FILTER (m = 2) AS top_2_agreement, max(v) FILTER (m = 3) AS top_3_agreement, avg(v) AS consistency_score FROM s""",
       real="top_1_agreement top_2_agreement top_3_agreement consistency_score", whole="n")
def explainer_agreement(t):
    a = linear(t)
    b = a.withColumn("contribution", F.when((F.col("customer_id") % 2 == 0) & (F.col("feature") == "balance"), F.col("contribution") / 100).otherwise(F.col("contribution")))
    return X.explainer_agreement(X.combined_explanations(scored(t), "customer_id", a, b), (1, 2, 3))


@query("shapley_attributions")
def shapley_attributions(t):
    s, score = prepared(t)
    return X.shapley_attributions(s, "customer_id", FEATURES, score, X.background_rows(s, "customer_id", FEATURES, 20), permutations=6)


def forest_trees(t):
    """A forest of 100 trees down to depth 10 on the scaled features, as a node table."""
    s = scaled(t)
    model = M.forest(numTrees=100, maxDepth=10).fit(M.assemble(s, FEATURES, ["customer_id", "label"]))
    return s, P.from_ml(model, s.sparkSession)


@query("tree_attributions")
def tree_attributions(t):
    s, trees = forest_trees(t)
    return X.tree_attributions(s, "customer_id", FEATURES, trees)


@query("tree_interactions")
def tree_interactions(t):
    s, trees = forest_trees(t)
    return X.tree_interaction_strengths(s, FEATURES, trees)


# a tree over frequency and balance with given splits; its covers are the customers below each node
SMALL_TREE = P.Trees(np.array([0]), np.array([0, 1, 1, -1, -1, -1, -1]), np.array([9.0, 4500.0, 1000.0, 0, 0, 0, 0]),
                     np.array([1, 3, 5, -1, -1, -1, -1]), np.array([2, 4, 6, -1, -1, -1, -1]), np.array([0, 0, 0, 0.9, 0.7, 0.4, 0.1]), np.zeros(7))
SMALL_SQL = """,
n AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (frequency <= 9)::DOUBLE AS l, count(*) FILTER (frequency <= 9 AND balance <= 4500)::DOUBLE AS ll,
             count(*) FILTER (frequency > 9 AND balance <= 1000)::DOUBLE AS rl FROM scored),
v AS (SELECT customer_id,
  (9e-1 * ll + 7e-1 * (l - ll) + 4e-1 * rl + 1e-1 * (n - l - rl)) / n AS f0,
  CASE WHEN frequency <= 9 THEN (9e-1 * ll + 7e-1 * (l - ll)) / l ELSE (4e-1 * rl + 1e-1 * (n - l - rl)) / (n - l) END AS ff,
  l / n * CASE WHEN balance <= 4500 THEN 9e-1 ELSE 7e-1 END + (n - l) / n * CASE WHEN balance <= 1000 THEN 4e-1 ELSE 1e-1 END AS fb,
  CASE WHEN frequency <= 9 THEN CASE WHEN balance <= 4500 THEN 9e-1 ELSE 7e-1 END ELSE CASE WHEN balance <= 1000 THEN 4e-1 ELSE 1e-1 END END AS fa
  FROM scored, n)
"""


@query("small_tree_attributions", WITH + SMALL_SQL + """SELECT customer_id, 'frequency' AS feature, (ff - f0 + fa - fb) / 2 AS contribution FROM v
UNION ALL SELECT customer_id, 'balance', (fb - f0 + fa - ff) / 2 FROM v""", real="contribution", digits=9)
def small_tree_attributions(t):
    s = scored(t)
    return X.tree_attributions(s, "customer_id", ["frequency", "balance"], X.with_background(s, ["frequency", "balance"], SMALL_TREE))


@query("small_tree_interactions", WITH + SMALL_SQL + """SELECT customer_id, 'frequency' AS feature1, 'balance' AS feature2, fa - ff - fb + f0 AS contribution FROM v
UNION ALL SELECT customer_id, 'frequency', 'frequency', (ff - f0 + fa - fb) / 2 - (fa - ff - fb + f0) / 2 FROM v
UNION ALL SELECT customer_id, 'balance', 'balance', (fb - f0 + fa - ff) / 2 - (fa - ff - fb + f0) / 2 FROM v""", real="contribution", digits=9)
def small_tree_interactions(t):
    s = scored(t)
    return X.tree_interactions(s, "customer_id", ["frequency", "balance"], X.with_background(s, ["frequency", "balance"], SMALL_TREE))


@query("interaction_strengths")
def interaction_strengths(t):
    s, score = prepared(t)
    return X.interaction_strengths(s, "customer_id", FEATURES, score, X.background_rows(s, "customer_id", FEATURES, 2))


@query("partial_dependence")
def partial_dependence(t):
    s, score = prepared(t)
    return X.partial_dependence(s, FEATURES, score)


@query("local_surrogate")
def local_surrogate(t):
    s, score = prepared(t)
    return X.local_surrogate(s, "customer_id", FEATURES, score)


@query("combined_explanations")
def combined_explanations(t):
    s, score = prepared(t)
    att = X.shapley_attributions(s, "customer_id", FEATURES, score, X.background_rows(s, "customer_id", FEATURES, 20), permutations=4)
    out = X.combined_explanations(score(s), "customer_id", att)
    return out.select("customer_id", "prediction", F.to_json("top_features").alias("top_features"))


@query("isolation_outliers")
def isolation_outliers_query(t):
    return isolation_outliers(scored(t).select("customer_id", "frequency", "monetary", "balance"), "customer_id", ["frequency", "monetary", "balance"])
