"""Recommendation queries over explanations derived from the scored customers."""

from pyspark.sql import functions as F

from retenta.operators import recommend as R
from workload.base import SCORED_SQL, scored
from workload.registry import query

# five contributions per customer, plain arithmetic on score, order count and balance
PARTS = {
    "monthly_charges": ("(score - 4.5e-1)", lambda: F.col("score") - 0.45),
    "tenure": ("(2e-1 - frequency / 50e0)", lambda: F.lit(0.2) - F.col("frequency") / F.lit(50.0)),
    "support_tickets": ("((customer_id % 7 - 3) / 20e0)", lambda: (F.col("customer_id") % 7 - 3) / F.lit(20.0)),
    "contract": ("((customer_id % 5 - 1) / 25e0)", lambda: (F.col("customer_id") % 5 - 1) / F.lit(25.0)),
    "login_activity": ("((customer_id % 11 - 6) / 30e0)", lambda: (F.col("customer_id") % 11 - 6) / F.lit(30.0)),
}


def explanations(t):
    s = scored(t)
    all_parts = F.array(*[F.struct(F.lit(n).alias("feature"), c().alias("contribution")) for n, (_, c) in PARTS.items()])
    s = s.select("customer_id", F.col("score").alias("prediction"), "monetary", all_parts.alias("attributions"))
    key = F.transform(F.col("attributions"), lambda f: F.struct((-F.abs(f["contribution"])).alias("k"), f["feature"].alias("feature"), f["contribution"].alias("contribution")))
    top = F.transform(F.slice(F.array_sort(key), 1, F.when(F.col("customer_id") % 9 == 0, 2).otherwise(4)),
                      lambda k: F.struct(k["feature"].alias("feature"), k["contribution"].alias("contribution")))
    flip = F.transform(F.col("attributions"), lambda f: F.struct(
        f["feature"].alias("feature"), F.when((f["feature"] == "tenure") & (F.col("customer_id") % 4 == 0), -f["contribution"]).otherwise(f["contribution"]).alias("contribution")))
    return s.withColumns({"top_features": top, "surrogate": flip})


EXPL = "WITH " + SCORED_SQL + """,
contrib AS (""" + " UNION ALL ".join(f"SELECT customer_id, score AS p, monetary, '{n}' AS feature, {e} AS c FROM scored" for n, (e, _) in PARTS.items()) + """),
ordered AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(c) DESC, feature) AS pos FROM contrib),
topf AS (SELECT * FROM ordered WHERE pos <= CASE WHEN customer_id % 9 = 0 THEN 2 ELSE 4 END),
table_actions AS (SELECT * FROM (VALUES """ + ", ".join(
    "('{}', {}, {}, '{}')".format(f, 1 if up else 0, i, a)
    for f, (lower, keep) in R.FEATURE_ACTIONS.items() for up, acts in ((True, lower), (False, keep)) for i, a in enumerate(acts)) + """) v(feature, up, i, action)),
hits AS (SELECT customer_id, action, min(pos * 10 + i) AS ord FROM topf JOIN table_actions USING (feature) WHERE up = CASE WHEN c > 0 THEN 1 ELSE 0 END GROUP BY ALL),
prim AS (SELECT customer_id, action, row_number() OVER (PARTITION BY customer_id ORDER BY ord) AS k FROM hits QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ord) <= 3),
prim_text AS (SELECT customer_id, string_agg(action, '; ' ORDER BY k) AS primary_actions, count(*) AS n_primary,
  least(sum(CASE WHEN lower(action) LIKE '%discount%' THEN 15e-2 WHEN lower(action) LIKE '%support%' THEN 1e-1 WHEN lower(action) LIKE '%engagement%' THEN 8e-2 ELSE 5e-2 END), 5e-1) AS eff,
  bool_or(lower(action) LIKE '%immediate%' OR lower(action) LIKE '%urgent%') AS urgent, bool_or(lower(action) LIKE '%value%' OR lower(action) LIKE '%discount%') AS value_word,
  count(*) FILTER (lower(action) LIKE '%immediate%' OR lower(action) LIKE '%urgent%' OR lower(action) LIKE '%discount%' OR lower(action) LIKE '%credit%') AS n_high,
  count(*) FILTER (lower(action) LIKE '%monitor%' OR lower(action) LIKE '%survey%' OR lower(action) LIKE '%newsletter%') AS n_low FROM prim GROUP BY 1),
base AS (SELECT customer_id, any_value(p) AS p, any_value(monetary) AS monetary, count(*) AS k, count(*) FILTER (abs(c) > 1e-1) AS strong,
  CASE WHEN any_value(p) >= 7e-1 THEN 'High' WHEN any_value(p) >= 3e-1 THEN 'Medium' ELSE 'Low' END AS risk,
  bool_or(feature = 'login_activity') AS usage, bool_or(feature = 'monthly_charges') AS billing, bool_or(feature = 'support_tickets') AS support,
  arg_min(feature, pos) AS f1, arg_min(c, pos) AS c1, string_agg(feature, ', ' ORDER BY pos) FILTER (pos IN (2, 3)) AS others FROM topf GROUP BY 1),
sec AS (SELECT customer_id, risk, CASE risk WHEN 'High' THEN ['Schedule immediate customer success call', 'Offer premium support upgrade', 'Provide executive escalation contact']
  WHEN 'Medium' THEN ['Send proactive engagement email', 'Offer product training session', 'Schedule quarterly business review']
  ELSE ['Include in customer satisfaction survey', 'Send product update newsletter', 'Monitor usage patterns'] END ||
  CASE WHEN usage THEN ['Provide usage optimization recommendations'] WHEN billing THEN ['Review billing and payment options'] WHEN support THEN ['Improve support experience'] ELSE [] END AS s FROM base),
recs AS (SELECT base.customer_id, p AS churn_probability, base.risk AS risk_level, coalesce(primary_actions, '') AS primary_actions, array_to_string(s, '; ') AS secondary_actions,
  least(p + p * 2e-1 * k / 10 + CASE WHEN base.customer_id % 3 = 0 THEN least((monetary / 1000) / 10000, 1) * 3e-1 ELSE 0 END, 1) AS priority_score,
  'Customer has ' || lower(base.risk) || ' churn risk (' || printf('%.1f', round_even(p * 1000, 0) / 10) || '% probability). Primary factor: ' || f1 ||
  CASE WHEN c1 > 0 THEN ' increases' ELSE ' decreases' END || ' churn risk.' || CASE WHEN k > 1 THEN ' Other key factors: ' || others || '.' ELSE '' END AS explanation_summary,
  least(strong / 5e0, 1) * 6e-1 + abs(p - 5e-1) * 2 * 4e-1 AS confidence, coalesce(eff, 0) AS retention_improvement, coalesce(eff, 0) * 1000 - 50 AS expected_value,
  coalesce(urgent, false) AS urgent, coalesce(value_word, false) AS value_word, coalesce(n_primary, 0) + len(s) AS n_actions, coalesce(n_high, 0) AS n_high, coalesce(n_low, 0) AS n_low,
  lower(coalesce(primary_actions, '') || ' ' || array_to_string(s, ' ')) AS all_text
  FROM base JOIN sec USING (customer_id) LEFT JOIN prim_text USING (customer_id)),
seg AS (SELECT *, CASE risk_level WHEN 'High' THEN CASE WHEN urgent THEN 'high_risk_immediate' ELSE 'high_risk_engagement' END
  WHEN 'Medium' THEN CASE WHEN value_word THEN 'medium_risk_value' ELSE 'medium_risk_proactive' END ELSE 'low_risk_monitoring' END AS campaign_segment FROM recs)
"""
REC_REAL = "churn_probability priority_score confidence retention_improvement expected_value"


def recs(t):
    values = scored(t).where("customer_id % 3 = 0").select("customer_id", (F.col("monetary") / 1000).alias("lifetime_value"))
    return R.recommend(explanations(t), "customer_id", values)


def flat(df):
    return df.withColumns({c: F.array_join(c, "; ") for c in ("primary_actions", "secondary_actions")}).drop("potential_revenue", "contact_cost")


REC_COLS = "customer_id, churn_probability, risk_level, primary_actions, secondary_actions, priority_score, explanation_summary, confidence, retention_improvement, expected_value"


@query("recommendations", EXPL + f"SELECT {REC_COLS} FROM recs", real=REC_REAL)
def recommendations(t):
    return flat(recs(t))


@query("prioritised_customers", EXPL + "SELECT customer_id, priority_score FROM recs ORDER BY round(priority_score, 9) DESC, customer_id LIMIT 200", real="priority_score")
def prioritised_customers(t):
    r = recs(t).withColumn("priority_score", F.round("priority_score", 9))
    return R.prioritise(r, "customer_id", 200).select("customer_id", "priority_score")


@query("campaign_segments", EXPL + "SELECT customer_id, campaign_segment FROM seg")
def campaign_segments(t):
    return R.with_campaign_segment(recs(t)).select("customer_id", "campaign_segment")


@query("campaign_summary", EXPL + """, act AS (SELECT campaign_segment, action, count(*) AS k FROM seg JOIN prim USING (customer_id) GROUP BY ALL),
tops AS (SELECT campaign_segment, string_agg(action, '; ' ORDER BY rn) AS top_actions FROM (SELECT *, row_number() OVER (PARTITION BY campaign_segment ORDER BY k DESC, action) AS rn FROM act) WHERE rn <= 3 GROUP BY 1)
SELECT campaign_segment, count(*) AS count, count(*) * 100e0 / (SELECT count(*) FROM seg) AS percentage, avg(churn_probability) AS avg_churn_probability, avg(priority_score) AS avg_priority_score,
  avg(confidence) AS avg_confidence, sum(expected_value) AS estimated_impact, any_value(top_actions) AS top_actions FROM seg LEFT JOIN tops USING (campaign_segment) GROUP BY 1""",
       real="percentage avg_churn_probability avg_priority_score avg_confidence estimated_impact", whole="count")
def campaign_summary(t):
    return R.campaign_summary(recs(t)).withColumn("top_actions", F.array_join("top_actions", "; "))


@query("campaign_overall", EXPL + """SELECT count(*) AS total_customers, avg(churn_probability) AS avg_churn_probability, avg(priority_score) AS avg_priority_score,
  sum(expected_value) AS estimated_total_impact FROM recs""", real="avg_churn_probability avg_priority_score estimated_total_impact", whole="total_customers")
def campaign_overall(t):
    return R.campaign_overall(recs(t))


@query("explanation_quality", EXPL + """,
iss AS (SELECT customer_id, count(*) FILTER (feature = 'tenure' AND customer_id % 4 = 0 AND abs(c) > 1e-2) + CASE WHEN abs(sum(c ORDER BY list_position(['monthly_charges', 'tenure', 'support_tickets', 'contract', 'login_activity'], feature)) + 5e-1 - any_value(p)) > 5e-2 THEN 1 ELSE 0 END AS n_issues FROM contrib GROUP BY 1),
war AS (SELECT customer_id, count(*) FILTER ((feature = 'monthly_charges' AND c <= 0) OR (feature = 'tenure' AND c >= 0)) + CASE WHEN count(*) < 3 THEN 1 ELSE 0 END + CASE WHEN sum(abs(c)) < 1e-1 THEN 1 ELSE 0 END AS n_warnings FROM topf GROUP BY 1)
SELECT customer_id, n_issues, n_warnings, greatest(0, 1 - n_issues * 2e-1 - n_warnings * 1e-1) AS quality_score,
  CASE WHEN n_issues > 0 THEN 'poor' WHEN n_warnings > 2 THEN 'fair' ELSE 'good' END AS overall_quality FROM iss JOIN war USING (customer_id)""",
       real="quality_score", whole="n_issues n_warnings")
def explanation_quality(t):
    q = R.explanation_quality(explanations(t), "customer_id")
    return q.select("customer_id", F.size("issues").alias("n_issues"), F.size("warnings").alias("n_warnings"), "quality_score", "overall_quality")


@query("business_alignment", EXPL + """,
al AS (SELECT customer_id, CASE risk_level WHEN 'Low' THEN n_high WHEN 'High' THEN n_low ELSE 0 END AS n_issues,
  CASE WHEN expected_value < 0 THEN 1 ELSE 0 END + CASE WHEN expected_value < 100 AND risk_level = 'Low' THEN 1 ELSE 0 END + CASE WHEN n_actions > 6 THEN 1 ELSE 0 END
  + CASE WHEN all_text LIKE '%discount%' AND all_text LIKE '%upgrade%' THEN 1 ELSE 0 END AS n_suggestions FROM recs)
SELECT customer_id, n_issues, n_suggestions, greatest(0, 1 - n_issues * 3e-1 - n_suggestions * 1e-1) AS alignment_score,
  CASE WHEN n_issues > 0 THEN 'poor' WHEN n_suggestions > 2 THEN 'fair' ELSE 'good' END AS business_alignment FROM al""",
       real="alignment_score", whole="n_issues n_suggestions")
def business_alignment(t):
    q = R.business_alignment(recs(t), "customer_id")
    return q.select("customer_id", F.size("issues").alias("n_issues"), F.size("suggestions").alias("n_suggestions"), "alignment_score", "business_alignment")


@query("band_actions", "WITH " + SCORED_SQL + ", b AS (SELECT customer_id, score, CASE WHEN score > 0 AND score <= 3e-1 THEN 'Low' WHEN score <= 7e-1 THEN 'Medium' ELSE 'High' END AS risk_level FROM scored) SELECT customer_id, CASE risk_level "
       + " ".join(f"WHEN '{k}' THEN '{'; '.join(v)}'" for k, v in R.BAND_ACTIONS.items())
       + f" END AS actions, CASE WHEN score > 8e-1 THEN '{R.BAND_HINTS[0][1]}' WHEN score > 6e-1 THEN '{R.BAND_HINTS[1][1]}' ELSE '{R.BAND_HINTS[2][1]}' END AS hint FROM b")
def band_actions(t):
    from retenta.operators.models import risk_band

    s = scored(t).select("customer_id", F.col("score").alias("churn_probability"), risk_band(F.col("score")).alias("risk_level"))
    return R.band_actions(s).select("customer_id", F.array_join("actions", "; ").alias("actions"), "hint")


@query("exported_recommendations", EXPL + "SELECT CAST(customer_id AS VARCHAR) AS customer_id, risk_level, primary_actions, secondary_actions, explanation_summary FROM recs WHERE primary_actions <> ''")
def exported_recommendations(t):
    import uuid

    from retenta.session import work_folder
    from retenta.sources.files import export_recommendations

    path = f"{work_folder(t.spark)}/recommendations-{uuid.uuid4().hex}"
    export_recommendations(recs(t), path, "csv")
    back = t.spark.read.option("header", True).csv(path)
    return back.where("primary_actions <> ''").select("customer_id", "risk_level", "primary_actions", "secondary_actions", "explanation_summary")
