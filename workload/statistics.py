"""Statistical tests and correlations on the scored customers."""

from pyspark.sql import functions as F

from retenta.operators import stats as S
from workload.base import SCORED_SQL, scored
from workload.registry import query

WITH = "WITH " + SCORED_SQL
CATS, NUMS = ["segment", "nation_key", "big_spender"], ["frequency", "balance", "monetary"]


def with_flags(t):
    return scored(t).withColumn("big_spender", F.when(F.col("monetary") > 2500000, "yes").otherwise("no"))


FLAGS = """,
flags AS (SELECT *, CASE WHEN monetary > 2500000 THEN 'yes' ELSE 'no' END AS big_spender FROM scored)
"""


@query("rate_by_category", WITH + "SELECT segment, avg(label) AS rate, count(*) AS n FROM scored GROUP BY segment", real="rate", whole="n")
def rate_by_category(t):
    return S.rate_by_category(scored(t), "segment", "label")


@query("contingency", WITH + "SELECT segment, label, count(*) AS n FROM scored GROUP BY ALL", whole="n")
def contingency(t):
    return S.contingency(scored(t), "segment", "label")


CHI = FLAGS + """,
cv AS (SELECT 'segment' AS "column", segment AS a, label AS b FROM flags UNION ALL SELECT 'nation_key', CAST(nation_key AS VARCHAR), label FROM flags
       UNION ALL SELECT 'big_spender', big_spender, label FROM flags),
cell AS (SELECT "column", a, b, count(*) AS o FROM cv GROUP BY ALL),
ra AS (SELECT "column", a, sum(o) AS r FROM cell GROUP BY ALL), cb AS (SELECT "column", b, sum(o) AS c FROM cell GROUP BY ALL),
tt AS (SELECT "column", sum(o) AS n FROM cell GROUP BY ALL),
shape AS (SELECT "column", count(DISTINCT a) AS nr, count(DISTINCT b) AS nc FROM cell GROUP BY ALL),
full_cells AS (SELECT ra."column", ra.a, cb.b, r::DOUBLE * c / n AS e, coalesce(o, 0) AS o, n, nr, nc FROM ra JOIN cb USING ("column") JOIN tt USING ("column")
               JOIN shape USING ("column") LEFT JOIN cell ON cell."column" = ra."column" AND cell.a = ra.a AND cell.b = cb.b),
chi AS (SELECT "column", any_value(n) AS n, (any_value(nr) - 1) * (any_value(nc) - 1) AS dof, any_value(least(nr, nc)) AS k, min(e) AS min_expected,
        sum(CASE WHEN (nr - 1) * (nc - 1) = 1 THEN power(greatest(abs(o - e) - 5e-1, 0), 2) / e ELSE power(o - e, 2) / e END) AS chi2
        FROM full_cells GROUP BY "column"),
chiv AS (SELECT *, sqrt(chi2 / (n * (k - 1))) AS v FROM chi)
"""
BAND = "CASE WHEN abs({v}) < 1e-1 THEN 'negligible' WHEN abs({v}) < 3e-1 THEN 'small' WHEN abs({v}) < 5e-1 THEN 'medium' ELSE 'large' END"


@query("chi_square", WITH + CHI + f"""SELECT "column", chi2 AS statistic, dof AS degrees_of_freedom, v AS effect_size, {BAND.format(v='v')} AS effect_interpretation,
  CASE WHEN min_expected < 5 THEN 'assumption_violated' ELSE 'valid' END AS interpretation, min_expected FROM chiv""",
       real="statistic effect_size min_expected", whole="degrees_of_freedom")
def chi_square(t):
    return S.chi_square(with_flags(t), CATS, "label").select(
        "column", "statistic", "degrees_of_freedom", "effect_size", "effect_interpretation", "interpretation", "min_expected")


RANKS = """,
nv AS (SELECT 'frequency' AS "column", frequency::DOUBLE AS x, label FROM scored UNION ALL SELECT 'balance', balance, label FROM scored
       UNION ALL SELECT 'monetary', monetary, label FROM scored),
rk AS (SELECT *, rank() OVER (PARTITION BY "column" ORDER BY x) + (count(*) OVER (PARTITION BY "column", x) - 1) / 2e0 AS r FROM nv),
mw AS (SELECT "column", sum(label) AS n1, count(*) - sum(label) AS n0,
       sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2e0 AS u FROM rk GROUP BY 1)
"""


@query("mann_whitney", WITH + RANKS + f"""SELECT "column", u AS statistic, 1 - 2 * u / (n1 * n0) AS effect_size,
  {BAND.format(v='(1 - 2 * u / (n1 * n0))')} AS effect_interpretation FROM mw""", real="statistic effect_size")
def mann_whitney(t):
    return S.mann_whitney(scored(t), NUMS, "label").select("column", "statistic", "effect_size", "effect_interpretation")


@query("group_statistics", WITH + RANKS + """SELECT "column", label, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS std, quantile_cont(x, 0.25) AS q25,
  quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q75 FROM nv GROUP BY ALL""", real="mean std q25 median q75", whole="n", digits=5)
def group_statistics(t):
    return S.group_statistics(scored(t), NUMS, "label")


@query("fisher_odds", WITH + FLAGS + """SELECT 'big_spender' AS "column",
  (count(*) FILTER (big_spender = 'no' AND label = 0) * count(*) FILTER (big_spender = 'yes' AND label = 1))::DOUBLE
  / (count(*) FILTER (big_spender = 'no' AND label = 1) * count(*) FILTER (big_spender = 'yes' AND label = 0)) AS odds_ratio FROM flags""",
       real="odds_ratio")
def fisher_odds(t):
    return S.fisher_exact(with_flags(t), ["big_spender"], "label").select("column", F.col("statistic").alias("odds_ratio"))


@query("kruskal_wallis", WITH + """,
rk AS (SELECT segment, balance, rank() OVER (ORDER BY balance) + (count(*) OVER (PARTITION BY balance) - 1) / 2e0 AS r, count(*) OVER () AS n FROM scored),
g AS (SELECT segment, sum(r) AS s, count(*) AS k, any_value(n) AS n FROM rk GROUP BY segment),
ties AS (SELECT sum(k::DOUBLE * k * k - k) AS t FROM (SELECT count(*) AS k FROM scored GROUP BY balance))
SELECT 'balance' AS "column", (12e0 / (any_value(n)::DOUBLE * (any_value(n) + 1)) * sum(s * s / k) - 3 * (any_value(n) + 1))
  / (1 - (SELECT t FROM ties) / (power(any_value(n), 3) - any_value(n))) AS statistic, count(*) - 1 AS degrees_of_freedom FROM g""",
       real="statistic", whole="degrees_of_freedom")
def kruskal_wallis(t):
    return S.kruskal_wallis(scored(t), "balance", "segment").select("column", "statistic", "degrees_of_freedom")


EFFECTS = RANKS + """,
es AS (SELECT "column", (avg(x) FILTER (label = 1) - avg(x) FILTER (label = 0)) / sqrt(((sum(label) - 1) * var_samp(x) FILTER (label = 1)
    + (count(*) - sum(label) - 1) * var_samp(x) FILTER (label = 0)) / (count(*) - 2)) AS cohens_d,
  corr(x, label) AS point_biserial_correlation, corr(r, label) AS spearman_correlation FROM rk GROUP BY "column")
"""


@query("effect_sizes", WITH + EFFECTS + "SELECT * FROM es", real="cohens_d point_biserial_correlation spearman_correlation")
def effect_sizes(t):
    return S.effect_sizes(scored(t), NUMS, "label")


@query("test_all")
def test_all(t):
    return S.test_all(with_flags(t).select("label", *NUMS, *CATS), "label")


@query("testing_report")
def testing_report(t):
    df = with_flags(t).select("label", *NUMS, "segment", "big_spender")
    return S.testing_report(S.test_all(df, "label", correction="holm"), S.effect_sizes(df, NUMS, "label"))


P_SQL = """,
pv AS (SELECT segment AS "column", avg(label) * 1e-1 AS p_value FROM scored GROUP BY 1)
"""


@query("holm_correction", WITH + P_SQL + """,
st AS (SELECT *, least(p_value * (count(*) OVER () - row_number() OVER (ORDER BY p_value, "column") + 1), 1) AS s FROM pv)
SELECT "column", p_value, max(s) OVER (ORDER BY p_value, "column" ROWS UNBOUNDED PRECEDING) AS p_value_corrected FROM st""",
       real="p_value p_value_corrected")
def holm_correction(t):
    p = S.rate_by_category(scored(t), "segment", "label").select(F.col("segment").alias("column"), (F.col("rate") * 0.1).alias("p_value"))
    return S.correct_p_values(p, "holm").select("column", "p_value", "p_value_corrected")


@query("bonferroni_correction", WITH + P_SQL + """SELECT "column", p_value, least(p_value * count(*) OVER (), 1) AS p_value_corrected FROM pv""",
       real="p_value p_value_corrected")
def bonferroni_correction(t):
    p = S.rate_by_category(scored(t), "segment", "label").select(F.col("segment").alias("column"), (F.col("rate") * 0.1).alias("p_value"))
    return S.correct_p_values(p, "bonferroni").select("column", "p_value", "p_value_corrected")


PAIRS = [("frequency", "balance"), ("frequency", "monetary"), ("balance", "monetary")]


@query("pearson_pairs", WITH + " UNION ALL ".join(
    f"SELECT '{a}' AS col1, '{b}' AS col2, corr({a}, {b}) AS r, count(*) AS n FROM scored" for a, b in PAIRS), real="r", whole="n")
def pearson_pairs(t):
    return S.correlation_pairs(scored(t), NUMS)


SPEAR = ", ranked AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0 AS {c}" for c in NUMS) + " FROM scored)"


@query("spearman_pairs", WITH + SPEAR + " UNION ALL ".join(
    f" SELECT '{a}' AS col1, '{b}' AS col2, corr({a}, {b}) AS r, count(*) AS n FROM ranked" for a, b in PAIRS), real="r", whole="n")
def spearman_pairs(t):
    return S.correlation_pairs(scored(t), NUMS, "spearman")


@query("high_pairs", WITH + SPEAR + ", c AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col1, '{b}' AS col2, corr({a}, {b}) AS r, count(*) AS n FROM ranked" for a, b in PAIRS) + ") SELECT * FROM c WHERE abs(r) > 7e-1",
       real="r", whole="n")
def high_pairs(t):
    return S.high_pairs(S.correlation_pairs(scored(t), NUMS, "spearman"))


@query("significant_pairs")
def significant_pairs(t):
    return S.significant_pairs(S.correlation_pairs(scored(t), NUMS, "spearman"))


@query("correlation_input", WITH + FLAGS + """SELECT customer_id, label, CASE WHEN big_spender = 'no' THEN 0 ELSE 1 END AS big_spender, """ + ", ".join(
    f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS segment_{s}" for s in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM flags")
def correlation_input(t):
    return S.prepare_correlation(with_flags(t).select("customer_id", "label", "big_spender", "segment"))


@query("cramers_v_pairs", WITH + FLAGS + """,
cv AS (SELECT 'segment' AS c1, 'big_spender' AS c2, segment AS a, big_spender AS b FROM flags UNION ALL SELECT 'segment', 'nation_key', segment, CAST(nation_key AS VARCHAR) FROM flags
       UNION ALL SELECT 'big_spender', 'nation_key', big_spender, CAST(nation_key AS VARCHAR) FROM flags),
cell AS (SELECT c1, c2, a, b, count(*) AS o FROM cv GROUP BY ALL),
m AS (SELECT *, sum(o) OVER (PARTITION BY c1, c2, a) AS r, sum(o) OVER (PARTITION BY c1, c2, b) AS c, sum(o) OVER (PARTITION BY c1, c2) AS n FROM cell),
v AS (SELECT c1, c2, sqrt(any_value(n) * (sum(o::DOUBLE * o / (r::DOUBLE * c)) - 1) / (any_value(n) * (least(count(DISTINCT a), count(DISTINCT b)) - 1))) AS v FROM m GROUP BY c1, c2)
SELECT c1 AS col1, c2 AS col2, v FROM v UNION ALL SELECT c2, c1, v FROM v
UNION ALL SELECT x, x, 1e0 FROM (VALUES ('segment'), ('big_spender'), ('nation_key')) d(x)""", real="v")
def cramers_v_pairs(t):
    return S.cramers_v_pairs(with_flags(t), ["segment", "big_spender", "nation_key"])


@query("analysis_summary")
def analysis_summary(t):
    df = with_flags(t)
    return S.analysis_summary(S.test_all(df.select("label", *NUMS, "segment"), "label"), S.correlation_pairs(df, NUMS, "spearman"))


@query("top_correlated", WITH + """,
c AS (SELECT 'score' AS "column", corr(score, label) AS r FROM scored UNION ALL SELECT 'frequency', corr(frequency, label) FROM scored
      UNION ALL SELECT 'balance', corr(balance, label) FROM scored UNION ALL SELECT 'monetary', corr(monetary, label) FROM scored)
SELECT * FROM c ORDER BY abs(r) DESC LIMIT 3""", real="r")
def top_correlated(t):
    return S.top_correlated(scored(t), "label", ["score", "frequency", "balance", "monetary"], 3)
