"""Lifetime value, ranking and campaign queries on orders and customers."""

from pyspark.sql import functions as F

from retenta.operators import campaign as P
from retenta.operators import clv as V
from retenta.params import Transactions
from retenta.session import settle
from workload.base import SCORED_SQL, scored
from workload.cleaning import CLEAN, telco_loaded
from workload.registry import query
from workload.timefeatures import ORDERS

WITH = "WITH " + SCORED_SQL
SUMMARY = """daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, sum(o_totalprice) AS v FROM orders GROUP BY ALL),
ps AS (SELECT o_custkey, count(*) - 1 AS frequency, date_diff('day', min(d), max(d))::DOUBLE AS recency, date_diff('day', min(d), (SELECT max(d) FROM daily))::DOUBLE AS "T",
  CASE WHEN count(*) > 1 THEN (sum(v) - arg_min(v, d)) / (count(*) - 1) ELSE 0 END AS monetary_value FROM daily GROUP BY o_custkey)"""


@query("purchase_summary", f"WITH {SUMMARY} SELECT * FROM ps", real="recency T monetary_value", whole="frequency")
def purchase_summary(t):
    return V.purchase_summary(t.orders, ORDERS)


@query("purchase_summary_simple", """SELECT o_custkey, count(*) - 1 AS frequency, date_sub('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS recency,
  date_sub('day', min(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS "T", sum(o_totalprice) AS monetary_value FROM orders GROUP BY 1""",
       real="monetary_value", whole="frequency recency T", digits=2)
def purchase_summary_simple(t):
    return V.purchase_summary_simple(t.orders, ORDERS)


def _fits(t):
    # money in thousands keeps the penalty from dominating the fit
    s = settle(V.purchase_summary(t.orders, ORDERS).withColumn("monetary_value", F.col("monetary_value") / 1000), "summary")
    return s, V.fit_bgnbd(s), V.fit_gamma_gamma(s)


@query("clv_fit_quality")
def clv_fit_quality(t):
    _, a, b = _fits(t)
    return V.fit_quality(t.spark, a, b)


@query("clv_predictions")
def clv_predictions(t):
    s, a, b = _fits(t)
    return V.predict_clv(s, "o_custkey", a, b)


@query("clv_heuristic", f"""WITH {SUMMARY}, c AS (SELECT o_custkey, frequency, recency, monetary_value, CASE WHEN "T" > 0 THEN frequency / "T" ELSE 0 END * 365 * exp(-recency / 365) * monetary_value AS predicted_clv FROM ps)
SELECT *, greatest(predicted_clv - 1.96e0 * 3e-1 * predicted_clv, 0) AS clv_lower_ci, predicted_clv + 1.96e0 * 3e-1 * predicted_clv AS clv_upper_ci FROM c""",
       real="recency monetary_value predicted_clv clv_lower_ci clv_upper_ci", whole="frequency")
def clv_heuristic(t):
    return V.predict_clv_heuristic(V.purchase_summary(t.orders, ORDERS), "o_custkey")


@query("simple_clv", f"""WITH {CLEAN}, c AS (SELECT "customerID", "MonthlyCharges" * greatest(24 - tenure, 6) AS v FROM loaded)
SELECT "customerID", greatest(v, 0) AS predicted_clv, v * 8e-1 AS clv_lower_ci, v * 1.2e0 AS clv_upper_ci FROM c""", real="predicted_clv clv_lower_ci clv_upper_ci")
def simple_clv(t):
    return V.simple_clv(telco_loaded(t), "customerID")


@query("simple_clv_totals", f"""WITH {CLEAN}, c AS (SELECT greatest("MonthlyCharges" * greatest(24 - tenure, 6), 0) AS v FROM loaded)
SELECT avg(v) AS mean_clv, quantile_cont(v, 0.5) AS median_clv, sum(v) AS total_clv FROM c""", real="mean_clv median_clv total_clv", digits=4)
def simple_clv_totals(t):
    return V.clv_totals(V.simple_clv(telco_loaded(t), "customerID"))


# ranking: probability = score, value = spending / 1000


def valued(t):
    return scored(t).select("customer_id", "label", F.col("score").alias("churn_probability"), (F.col("monetary") / 1000).alias("predicted_clv"))


VALUED = """,
val AS (SELECT customer_id, label, score AS churn_probability, monetary / 1000 AS predicted_clv, score * 3e-1 * (monetary / 1000) - 5e1 AS expected_value FROM scored),
pri AS (SELECT *, (expected_value - (SELECT min(expected_value) FROM val)) / ((SELECT max(expected_value) FROM val) - (SELECT min(expected_value) FROM val)) AS priority_score,
  predicted_clv >= 100 AS meets_clv_threshold, churn_probability >= 1e-1 AS meets_churn_threshold,
  predicted_clv >= 100 AND churn_probability >= 1e-1 AND expected_value > 0 AS eligible_for_intervention FROM val),
cut AS (SELECT quantile_cont(priority_score, 0.5) AS q5, quantile_cont(priority_score, 0.8) AS q8 FROM pri WHERE eligible_for_intervention),
ranking AS (SELECT customer_id, churn_probability, predicted_clv, expected_value, priority_score, meets_clv_threshold, meets_churn_threshold, eligible_for_intervention,
  CASE WHEN NOT eligible_for_intervention THEN 'Low' WHEN priority_score >= q8 THEN 'High' WHEN priority_score >= q5 THEN 'Medium' ELSE 'Low' END AS priority_tier,
  row_number() OVER (ORDER BY priority_score DESC, customer_id) AS rank FROM pri, cut),
elig AS (SELECT *, row_number() OVER (ORDER BY rank) AS place, sum(expected_value) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum_value FROM ranking WHERE eligible_for_intervention),
tgt AS (SELECT * FROM elig WHERE place <= 200)
"""


@query("retention_value", WITH + VALUED + "SELECT customer_id, expected_value FROM val", real="expected_value")
def retention_value(t):
    return valued(t).select("customer_id", P.retention_value(F.col("churn_probability"), F.col("predicted_clv")).alias("expected_value"))


@query("rank_customers", WITH + VALUED + "SELECT * FROM ranking", real="churn_probability predicted_clv expected_value priority_score", whole="rank")
def rank_customers(t):
    return P.rank_customers(valued(t), "customer_id")


@query("cost_benefit", WITH + VALUED + """SELECT count(*) AS total_customers_targeted, count(*) * 5e1 AS total_cost, sum(expected_value) + count(*) * 5e1 AS expected_savings,
  sum(expected_value) AS expected_net_benefit, sum(expected_value) / (count(*) * 5e1) AS expected_roi, (SELECT min(place) FROM elig WHERE cum_value > 0) AS break_even_customers,
  count(*) * 5e1 / 1e4 AS budget_utilization, avg(churn_probability) AS avg_churn_probability, avg(predicted_clv) AS avg_clv, avg(priority_score) AS avg_priority_score FROM tgt""",
       real="total_cost expected_savings expected_net_benefit expected_roi budget_utilization avg_churn_probability avg_clv avg_priority_score",
       whole="total_customers_targeted break_even_customers", digits=5)
def cost_benefit(t):
    return P.cost_benefit(P.rank_customers(valued(t), "customer_id"), "customer_id")


@query("tier_analysis", WITH + VALUED + """SELECT priority_tier, count(*) AS count, sum(expected_value) AS total_expected_value, avg(churn_probability) AS avg_churn_probability,
  avg(predicted_clv) AS avg_clv FROM tgt GROUP BY 1""", real="total_expected_value avg_churn_probability avg_clv", whole="count", digits=5)
def tier_analysis(t):
    return P.tier_analysis(P.rank_customers(valued(t), "customer_id"), "customer_id")


def _pick(values) -> str:
    return "CASE k " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query("campaign_recommendations", WITH + VALUED + f""",
b AS (SELECT *, CASE WHEN churn_probability >= 7e-1 AND predicted_clv >= 1000 THEN 0 WHEN churn_probability >= 5e-1 AND predicted_clv >= 500 THEN 1 WHEN churn_probability >= 3e-1 THEN 2 ELSE 3 END AS k FROM elig WHERE place <= 100)
SELECT customer_id, rank, priority_tier, churn_probability, predicted_clv AS clv_estimate, expected_value, {_pick(f"'{c[0]}'" for c in P.CAMPAIGNS)} AS recommendation_type,
  {_pick(f"'{c[1]}'" for c in P.CAMPAIGNS)} AS urgency, {_pick(f"{c[2]:.0f}e0" for c in P.CAMPAIGNS)} AS estimated_intervention_cost,
  {_pick("'" + '; '.join(c[3]) + "'" for c in P.CAMPAIGNS)} AS suggested_actions FROM b""", real="churn_probability clv_estimate expected_value", whole="rank")
def campaign_recommendations(t):
    out = P.campaign_recommendations(P.rank_customers(valued(t), "customer_id"), "customer_id")
    return out.withColumn("suggested_actions", F.array_join("suggested_actions", "; "))


@query("campaign_targeting", WITH + """, top AS (SELECT score FROM scored ORDER BY score DESC, customer_id LIMIT 1000)
SELECT count(*) AS total_contacts, count(*) * 5e1 AS total_cost, count(*) * avg(score) * 3e-1 AS expected_retentions, count(*) * avg(score) * 3e-1 * 1000 AS expected_revenue,
  (count(*) * avg(score) * 3e-1 * 1000 - count(*) * 5e1) * 100 / (count(*) * 5e1) AS expected_roi FROM top""",
       real="total_cost expected_retentions expected_revenue expected_roi", whole="total_contacts")
def campaign_targeting(t):
    return P.campaign_targeting(valued(t), "customer_id")


@query("roi_by_percent", WITH + """, r AS (SELECT row_number() OVER w AS rank, sum(score) OVER w AS s, count(*) OVER () AS n FROM scored WINDOW w AS (ORDER BY score DESC, customer_id ROWS UNBOUNDED PRECEDING))
SELECT pct AS percent, rank AS n_contacts, (s * 3e-1 * 1000 - rank * 5e1) * 100 / (rank * 5e1) AS roi FROM r, (VALUES (10), (20), (30), (40), (50)) x(pct) WHERE rank = n * pct // 100""",
       real="roi", whole="percent n_contacts")
def roi_by_percent(t):
    return P.roi_by_percent(valued(t), "customer_id")


@query("kpis", WITH + """SELECT count(*) AS total_customers, count(*) FILTER (score > 7e-1) AS high_risk, count(*) FILTER (score > 7e-1) * 100e0 / count(*) AS high_risk_pct, avg(score) AS avg_risk,
  sum(CASE WHEN score >= 5e-1 AND label = 1 THEN 1450e0 WHEN score >= 5e-1 THEN -50e0 ELSE 0 END) AS net_savings FROM scored""",
       real="high_risk_pct avg_risk net_savings", whole="total_customers high_risk")
def kpis(t):
    return P.kpis(valued(t))


@query("high_risk", WITH + "SELECT customer_id, score AS churn_probability FROM scored WHERE score >= 6e-1 ORDER BY score DESC, customer_id LIMIT 50", real="churn_probability")
def high_risk(t):
    return P.high_risk(valued(t), "customer_id", threshold=0.6, top=50).select("customer_id", "churn_probability")


@query("scores_with_clv", WITH + VALUED + """SELECT scored.customer_id, score, predicted_clv FROM scored LEFT JOIN (SELECT customer_id, predicted_clv FROM val WHERE customer_id % 3 = 0) v USING (customer_id)""", real="score predicted_clv")
def scores_with_clv(t):
    clv = valued(t).where("customer_id % 3 = 0").select(F.col("customer_id").cast("string").alias("customer_id"), "predicted_clv")
    return P.with_clv(scored(t).select("customer_id", "score"), clv, "customer_id")
