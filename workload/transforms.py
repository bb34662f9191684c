"""Feature transform queries on customers, orders and parts."""

from pyspark.sql import functions as F

from retenta.operators import neighbours as N
from retenta.operators import splits as L
from retenta.operators import transform as X
from retenta.operators.widepca import fit_wide_pca
from workload.base import SCORED_SQL, scored
from workload.registry import query

WITH = "WITH " + SCORED_SQL
NUMS = ["frequency", "monetary", "balance"]


def gappy(t):
    return scored(t).select("customer_id", "label", F.when(F.col("customer_id") % 6 != 0, F.col("balance")).alias("balance"),
                            F.when(F.col("customer_id") % 7 != 0, F.col("segment")).alias("segment"), F.col("frequency").cast("double").alias("frequency"))


GAPPY = """,
gappy AS (SELECT customer_id, label, CASE WHEN customer_id % 6 <> 0 THEN balance END AS balance, CASE WHEN customer_id % 7 <> 0 THEN segment END AS segment,
  frequency::DOUBLE AS frequency FROM scored),
filled AS (SELECT * REPLACE (coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM gappy)) AS balance) FROM gappy),
lim AS (SELECT quantile_cont(balance, 0.01) b1, quantile_cont(balance, 0.99) b9, quantile_cont(frequency, 0.01) f1, quantile_cont(frequency, 0.99) f9 FROM filled),
clipped AS (SELECT customer_id, least(greatest(balance, b1), b9) AS balance, least(greatest(frequency, f1), f9) AS frequency FROM filled, lim)
"""


@query("numeric_standard", WITH + GAPPY + """, s AS (SELECT avg(balance) bm, stddev_pop(balance) bs, avg(frequency) fm, stddev_pop(frequency) fs FROM clipped)
SELECT customer_id, (balance - bm) / bs AS balance, (frequency - fm) / fs AS frequency FROM clipped, s""", real="balance frequency")
def numeric_standard(t):
    g = gappy(t)
    return X.apply_numeric(g, X.fit_numeric(g, ["balance", "frequency"])).select("customer_id", "balance", "frequency")


@query("numeric_minmax", WITH + GAPPY + """, s AS (SELECT min(balance) bm, max(balance) - min(balance) bs, min(frequency) fm, max(frequency) - min(frequency) fs FROM clipped)
SELECT customer_id, (balance - bm) / bs AS balance, (frequency - fm) / fs AS frequency FROM clipped, s""", real="balance frequency")
def numeric_minmax(t):
    g = gappy(t)
    return X.apply_numeric(g, X.fit_numeric(g, ["balance", "frequency"], scale="minmax")).select("customer_id", "balance", "frequency")


@query("numeric_robust", WITH + GAPPY + """, s AS (SELECT quantile_cont(balance, 0.5) bm, quantile_cont(balance, 0.75) - quantile_cont(balance, 0.25) bs,
  quantile_cont(frequency, 0.5) fm, quantile_cont(frequency, 0.75) - quantile_cont(frequency, 0.25) fs FROM clipped)
SELECT customer_id, (balance - bm) / bs AS balance, (frequency - fm) / fs AS frequency FROM clipped, s""", real="balance frequency")
def numeric_robust(t):
    g = gappy(t)
    return X.apply_numeric(g, X.fit_numeric(g, ["balance", "frequency"], scale="robust")).select("customer_id", "balance", "frequency")


@query("one_hot", WITH + GAPPY + """, m AS (SELECT segment AS v FROM gappy WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), f AS (SELECT customer_id, coalesce(segment, v) AS s FROM gappy, m)
SELECT customer_id, """ + ", ".join(f"CASE WHEN s = '{s}' THEN 1e0 ELSE 0e0 END AS segment_{s}" for s in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM f")
def one_hot(t):
    g = gappy(t).select("customer_id", "segment")
    return X.one_hot(g, X.fit_categories(g, ["segment"]))


def _places(col, first):
    return f"""SELECT customer_id, {first} + pos - 2 AS place FROM (SELECT customer_id, coalesce({col}, (SELECT {col} FROM wide WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS v FROM wide)
JOIN (SELECT v, row_number() OVER (ORDER BY v) AS pos FROM (SELECT DISTINCT {col} AS v FROM wide WHERE {col} IS NOT NULL)) USING (v) WHERE pos > 1"""


# names are as many as customers: more values than one_hot takes as columns
@query("sparse_one_hot", WITH + """,
wide AS (SELECT customer_id, CASE WHEN customer_id % 7 <> 0 THEN segment END AS segment, c_name AS name FROM scored JOIN customer ON c_custkey = customer_id),
n AS (SELECT count(DISTINCT segment) - 1 AS k FROM wide)
""" + _places("segment", 0) + " UNION ALL " + _places("name", "(SELECT k FROM n)"), whole="place")
def sparse_one_hot(t):
    names = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"))
    s = scored(t).select("customer_id", F.when(F.col("customer_id") % 7 != 0, F.col("segment")).alias("segment")).join(names, "customer_id")
    out = X.sparse_one_hot(s, ["segment", "name"], X.fit_category_codes(s, ["segment", "name"]))
    return out.select("customer_id", F.explode(X.places_on(F.col("features"))).alias("r")).select("customer_id", "r.place")


@query("target_encoding", WITH + """, a AS (SELECT avg(label) m, var_pop(label) v FROM scored), g AS (SELECT segment, count(*) n, avg(label) gm, var_pop(label) gv FROM scored GROUP BY 1),
e AS (SELECT segment, (v * n) / (v * n + gv) AS w, gm, m FROM g, a)
SELECT customer_id, w * gm + (1 - w) * m AS segment FROM scored JOIN e USING (segment)""", real="segment")
def target_encoding(t):
    s = scored(t).select("customer_id", "segment", "label")
    return X.target_encode(s, "segment", X.fit_target_encoding(s, "segment", "label")).select("customer_id", "segment")


@query("target_encoding_cross_fitted", WITH + """,
f AS (SELECT customer_id, segment, label, (row_number() OVER (PARTITION BY label ORDER BY md5('42|' || customer_id), customer_id) - 1) % 5 AS fold FROM scored),
g AS (SELECT segment, fold, count(*) n, sum(label) s FROM f GROUP BY ALL),
x AS (SELECT segment, fold, sum(n) OVER (PARTITION BY segment) - n AS n, sum(s) OVER (PARTITION BY segment) - s AS s,
  (sum(s) OVER () - sum(s) OVER (PARTITION BY fold)) / (sum(n) OVER () - sum(n) OVER (PARTITION BY fold)) AS o FROM g),
e AS (SELECT segment, fold, s / n AS m, o, o * (1 - o) * n AS sp FROM x)
SELECT customer_id, sp / (sp + m * (1 - m)) * m + (1 - sp / (sp + m * (1 - m))) * o AS encoding FROM f JOIN e USING (segment, fold)""", real="encoding")
def target_encoding_cross_fitted(t):
    f = L.stratified_folds(scored(t).select("customer_id", "segment", "label"), "customer_id", "label")
    return X.target_encode_cross_fitted(f, "segment", "label", "fold").select("customer_id", "encoding")


@query("interactions", WITH + """SELECT customer_id, balance * frequency AS balance_x_frequency, balance / frequency AS balance_div_frequency,
  balance * nation_key AS balance_x_nation_key, frequency * nation_key AS frequency_x_nation_key FROM scored""",
       real="balance_x_frequency balance_div_frequency balance_x_nation_key frequency_x_nation_key")
def interactions(t):
    out = X.interactions(scored(t), ["balance", "frequency", "nation_key"])
    return out.select("customer_id", *[c for c in out.columns if "_x_" in c or "_div_" in c])


def _anova(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", (sum(n * power(m - mm, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS score FROM "
            f"(SELECT count({c}) n, avg({c}) m, var_pop({c}) v, any_value(mm) mm FROM scored, (SELECT avg({c}) mm FROM scored) GROUP BY label)")


@query("anova_scores", WITH + " UNION ALL ".join(_anova(c) for c in NUMS), real="score")
def anova_scores(t):
    return X.anova_scores(scored(t), NUMS, "label")


def _mi(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", sum(n / tot * ln(n * tot / (nx * ny))) AS score FROM (SELECT n::DOUBLE AS n, sum(n) OVER ()::DOUBLE AS tot, sum(n) OVER (PARTITION BY x)::DOUBLE AS nx, "
            f"sum(n) OVER (PARTITION BY label)::DOUBLE AS ny FROM (SELECT label, len(list_filter(list_distinct(q), lambda e: {c} > e)) AS x, count(*) AS n FROM scored, "
            f"(SELECT quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM scored) GROUP BY ALL))")


@query("mutual_information", WITH + " UNION ALL ".join(_mi(c) for c in NUMS), real="score")
def mutual_information(t):
    return X.mutual_information_scores(scored(t), NUMS, "label")


def _psi(n):
    """Digamma of a whole number, as in the operator: expansion at n + 8, less the steps back."""
    steps = " + ".join(f"1e0 / ({n} + {i})" for i in range(8))
    x = f"({n} + 8e0)"
    return (f"(ln({x}) - 1e0 / (2 * {x}) - 1e0 / (12 * {x} ** 2) + 1e0 / (120 * {x} ** 4) - 1e0 / (252 * {x} ** 6) + 1e0 / (240 * {x} ** 8) - ({steps}))")


NEIGHBOURS = WITH + """,
long AS (""" + " UNION ALL ".join(f"""SELECT '{c}' AS "column", customer_id AS i, label AS c, {c}::DOUBLE AS v FROM scored""" for c in NUMS) + """),
sizes AS (SELECT "column", c, count(*) AS size FROM long GROUP BY ALL HAVING count(*) > 1),
pts AS (SELECT l.*, size, least(3, size - 1) AS k FROM long l JOIN sizes USING ("column", c)),
near AS (
  SELECT "column", a.i, any_value(a.v) AS v, any_value(a.k) AS k, any_value(a.size) AS size, list_sort(list(abs(b.v - a.v)))[any_value(a.k)] AS r,
         1 + count(*) FILTER (b.v = a.v) AS equal
  FROM pts a JOIN pts b USING ("column", c) WHERE a.i <> b.i GROUP BY "column", a.i
),
counted AS (
  SELECT "column", a.i, any_value(CASE WHEN r = 0 THEN equal ELSE a.k END) AS k, any_value(a.size) AS size, count(*) AS m FROM near a JOIN pts b USING ("column")
  WHERE abs(b.v - a.v) < a.r OR (a.r = 0 AND b.v = a.v) GROUP BY "column", a.i
)
SELECT "column", greatest(0e0, """ + _psi("count(*)") + f" + avg({_psi('k')}) - avg({_psi('size')}) - avg({_psi('m')})" + """) AS score FROM counted GROUP BY "column" """


@query("neighbour_mutual_information", NEIGHBOURS, real="score", digits=9)
def neighbour_mutual_information(t):
    return N.neighbour_mutual_information(scored(t), NUMS, "label").withColumnRenamed("feature", "column")


@query("variance_importance", WITH + """, v AS (SELECT 'frequency' AS "column", var_pop(frequency) AS score FROM scored UNION ALL SELECT 'score', var_pop(score) FROM scored
  UNION ALL SELECT 'label', var_pop(label) FROM scored) SELECT *, score > 1e-2 AS selected FROM v""", real="score")
def variance_importance(t):
    return X.importance_table(X.variance_scores(scored(t), ["frequency", "score", "label"]), above=0.01)


@query("feature_importance", WITH + ", a AS (" + " UNION ALL ".join(_anova(c) for c in NUMS) + ') SELECT *, row_number() OVER (ORDER BY score DESC, "column") <= 2 AS selected FROM a', real="score")
def feature_importance(t):
    return X.importance_table(X.anova_scores(scored(t), NUMS, "label"), top=2)


@query("principal_components")
def principal_components(t):
    s = scored(t)
    s = X.apply_numeric(s, X.fit_numeric(s, NUMS))
    return X.apply_pca(s, X.fit_pca(s, NUMS, 2)).select("customer_id", "pc1", "pc2")


# customers x brands: money spent, whole units; absent pairs are zero
SPENT = """WITH spent AS (SELECT o_custkey AS row, p_brand AS col, CAST(floor(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 100000) AS DOUBLE) AS value
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
n AS (SELECT count(DISTINCT row) AS n FROM spent),
means AS (SELECT col, sum(value) / any_value(n) AS mean FROM spent, n GROUP BY 1),
products AS (SELECT a.col AS i, b.col AS j, sum(a.value * b.value) AS s FROM spent a JOIN spent b USING (row) GROUP BY 1, 2),
cov AS (SELECT a.col AS i, b.col AS j, (coalesce(s, 0) - n * a.mean * b.mean) / (n - 1) AS c
        FROM means a CROSS JOIN means b CROSS JOIN n LEFT JOIN products ON i = a.col AND j = b.col),
squares AS (SELECT a.i, b.j, sum(a.c * b.c) AS c FROM cov a JOIN cov b ON a.j = b.i GROUP BY 1, 2)"""


def spent(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    joined = lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey")).join(
        t.part.select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    return joined.groupBy(F.col("o_custkey").alias("row"), F.col("p_brand").alias("column")).agg(
        F.floor(F.sum("cents") / F.lit(100000)).cast("double").alias("value"))


@query("wide_pca_moments", SPENT + """, t AS (SELECT sum(c) AS total FROM cov WHERE i = j)
SELECT total, (SELECT sum(c) FROM squares WHERE i = j) / (total * total) AS squares,
  (SELECT sum(a.c * b.c) FROM squares a JOIN cov b ON a.j = b.i AND a.i = b.j) / (total * total * total) AS cubes FROM t""",
       real="total squares cubes", digits=8)
def wide_pca_moments(t):
    """All components of spending by brand: sums of powers of their shares are traces of powers of the covariance."""
    v, total = F.col("variance"), F.sum("variance")
    parts = fit_wide_pca(spent(t), t.part.select("p_brand").distinct().count()).components
    return parts.agg(total.alias("total"), (F.sum(v * v) / (total * total)).alias("squares"),
                     (F.sum(v * v * v) / (total * total * total)).alias("cubes"))


@query("wide_pca_components")
def wide_pca_components(t):
    """The first five components of spending by brand."""
    return fit_wide_pca(spent(t), 5).components


@query("feature_pipeline")
def feature_pipeline(t):
    g = gappy(t)
    p = X.FeaturePipeline(with_interactions=True, selection="f_classif", max_features=4, keep=["customer_id"]).fit(g, "label")
    return p.transform(g)


TIMED = "WITH " + SCORED_SQL + """,
tx AS (SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderdate AS ordered, o_totalprice AS price FROM orders),
r AS (SELECT customer_id, count(*)::DOUBLE AS frequency, date_sub('day', max(ordered), (SELECT max(ordered) FROM tx))::DOUBLE AS recency FROM tx GROUP BY 1),
j AS (SELECT order_key, price, r.frequency, r.recency FROM tx JOIN r USING (customer_id)),
l AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.01) AS {c}1, quantile_cont({c}, 0.99) AS {c}9" for c in ("price", "frequency", "recency")) + """ FROM j),
w AS (SELECT order_key, """ + ", ".join(f"least(greatest({c}, {c}1), {c}9) AS {c}" for c in ("price", "frequency", "recency")) + """ FROM j, l),
m AS (SELECT """ + ", ".join(f"avg({c}) AS {c}m, stddev_pop({c}) AS {c}s" for c in ("price", "frequency", "recency")) + """ FROM w)
SELECT order_key, """ + ", ".join(f"({c} - {c}m) / {c}s AS {c}" for c in ("price", "frequency", "recency")) + " FROM w, m"


@query("feature_pipeline_temporal", TIMED, real="price frequency recency", digits=8)
def feature_pipeline_temporal(t):
    """Orders with their customers' figures, all scaled; customer, date and value columns are inferred."""
    tx = t.orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("ordered"), F.col("o_totalprice").alias("price"))
    out = X.FeaturePipeline(with_temporal=True, keep=["order_key"]).fit(tx).transform(tx)
    return out.select("order_key", "price", F.col("rfm_frequency").alias("frequency"), F.col("rfm_recency_days").alias("recency"))
