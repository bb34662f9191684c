"""Retention ranking, budgets, campaign recommendations and dashboard figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.expr import ratio
from retenta.params import BusinessParams, CampaignParams
from retenta.plans.order import running_totals, with_rank
from retenta.plans.quantiles import fit_quantiles
from retenta.plans.scoretable import confusion, join_groups


def retention_value(p: Column, clv: Column, params: CampaignParams = CampaignParams()) -> Column:
    return p * params.retention_effectiveness * clv - params.retention_cost


def rank_customers(df: DataFrame, ident: str, p: str = "churn_probability", clv: str = "predicted_clv",
                   params: CampaignParams = CampaignParams()) -> DataFrame:
    """Min-max priority of the expected value, eligibility, tiers (80th / 50th percentile of the eligible) and rank."""
    out = df.select(ident, p, clv).withColumn("expected_value", retention_value(F.col(p), F.col(clv), params))
    span = out.agg(F.struct(F.min("expected_value").alias("lo"), F.max("expected_value").alias("hi")).alias("s")).scalar()
    out = out.withColumn("s", span)
    out = out.withColumn("priority_score", F.when(F.col("s.hi") > F.col("s.lo"), (F.col("expected_value") - F.col("s.lo"))
                                                  / (F.col("s.hi") - F.col("s.lo"))).otherwise(F.lit(0.5))).drop("s")
    out = out.withColumns({"meets_clv_threshold": F.col(clv) >= params.min_clv, "meets_churn_threshold": F.col(p) >= params.min_probability})
    eligible = F.col("meets_clv_threshold") & F.col("meets_churn_threshold") & (F.col("expected_value") > 0)
    out = out.withColumn("eligible_for_intervention", eligible)
    cuts = fit_quantiles(out.where("eligible_for_intervention"), ["priority_score"], [0.5, 0.8])["priority_score"]
    tier = F.lit("Low")
    if cuts[0] is not None:
        tier = F.when(~F.col("eligible_for_intervention"), "Low").when(F.col("priority_score") >= F.lit(cuts[1]), "High").when(
            F.col("priority_score") >= F.lit(cuts[0]), "Medium").otherwise("Low")
    return with_rank(out.withColumn("priority_tier", tier), "priority_score", ident, descending=True)


def _targeted(ranked: DataFrame, ident: str, budget: float, params: CampaignParams) -> DataFrame:
    """Eligible rows with their place, running value and a flag for those within budget."""
    cap = int(budget / params.retention_cost)
    eligible = ranked.where("eligible_for_intervention")
    placed = running_totals(eligible, "rank", {"place": F.lit(1).cast("long"), "cum_value": F.col("expected_value")})
    return placed.withColumn("targeted", F.col("place") <= cap)


def cost_benefit(ranked: DataFrame, ident: str, p: str = "churn_probability", clv: str = "predicted_clv",
                 budget: float = 10000.0, params: CampaignParams = CampaignParams()) -> DataFrame:
    """Budgeted campaign figures, one row.  `break_even_customers` is the number of
    best customers after which the running expected value is first positive (0 if never)."""
    t = _targeted(ranked, ident, budget, params)
    hit = F.col("targeted")
    n = F.coalesce(F.count_if(hit), F.lit(0))
    cost = n * F.lit(params.retention_cost)

    def over(c: Column, fn=F.avg) -> Column:
        return fn(F.when(hit, c))

    value = F.coalesce(over(F.col("expected_value"), F.sum), F.lit(0.0))
    return t.agg(
        n.alias("total_customers_targeted"), cost.alias("total_cost"), (value + cost).alias("expected_savings"),
        value.alias("expected_net_benefit"), ratio(value, cost, 0).alias("expected_roi"),
        F.coalesce(F.min(F.when(F.col("cum_value") > 0, F.col("place"))), F.lit(0)).alias("break_even_customers"),
        (cost / F.lit(budget)).alias("budget_utilization"), over(F.col(p)).alias("avg_churn_probability"),
        over(F.col(clv)).alias("avg_clv"), over(F.col("priority_score")).alias("avg_priority_score"))


def tier_analysis(ranked: DataFrame, ident: str, p: str = "churn_probability", clv: str = "predicted_clv",
                  budget: float = 10000.0, params: CampaignParams = CampaignParams()) -> DataFrame:
    """Targeted customers by tier."""
    t = _targeted(ranked, ident, budget, params).where("targeted")
    return t.groupBy("priority_tier").agg(
        F.count(F.lit(1)).alias("count"), F.sum("expected_value").alias("total_expected_value"),
        F.avg(p).alias("avg_churn_probability"), F.avg(clv).alias("avg_clv"))


# fixed values: campaign kinds by probability and value bands
CAMPAIGNS = (
    ("Immediate Personal Outreach", "Critical", 50.0, ("Schedule immediate call with account manager",
                                                       "Offer personalized retention package", "Investigate specific pain points")),
    ("Targeted Retention Campaign", "High", 50.0, ("Send personalized email with special offer",
                                                   "Provide loyalty program benefits", "Offer product usage consultation")),
    ("Proactive Engagement", "Medium", 25.0, ("Include in next newsletter campaign", "Offer educational content",
                                              "Monitor usage patterns closely")),
    ("Standard Monitoring", "Low", 25.0, ("Include in regular communication", "Track engagement metrics")),
)


def campaign_recommendations(ranked: DataFrame, ident: str, p: str = "churn_probability", clv: str = "predicted_clv",
                             top: int = 100) -> DataFrame:
    """The best eligible customers with campaign kind, urgency, actions and cost."""
    best = ranked.where("eligible_for_intervention").orderBy("rank").limit(top)
    kind = F.when((F.col(p) >= 0.7) & (F.col(clv) >= 1000), 0).when((F.col(p) >= 0.5) & (F.col(clv) >= 500), 1).when(
        F.col(p) >= 0.3, 2).otherwise(3)
    table = F.array(*[F.struct(F.lit(n).alias("recommendation_type"), F.lit(u).alias("urgency"), F.lit(c).alias("estimated_intervention_cost"),
                               F.array(*[F.lit(a) for a in acts]).alias("suggested_actions")) for n, u, c, acts in CAMPAIGNS])
    return best.withColumn("k", F.get(table, kind)).select(
        ident, "rank", "priority_tier", p, F.col(clv).alias("clv_estimate"), "expected_value", "k.*")


def campaign_targeting(df: DataFrame, ident: str, p: str = "churn_probability", budget: float = 50000.0, cost: float = 50.0,
                       value: float = 1000.0, effectiveness: float = 0.3) -> DataFrame:
    """Contact as many of the likeliest leavers as the budget allows."""
    top = df.select(ident, p).orderBy(F.col(p).desc(), ident).limit(int(budget / cost))
    n, spent = F.count(F.lit(1)), F.count(F.lit(1)) * F.lit(cost)
    kept = n * F.avg(p) * F.lit(effectiveness)
    return top.agg(n.alias("total_contacts"), spent.alias("total_cost"), kept.alias("expected_retentions"),
                   (kept * value).alias("expected_revenue"), ratio((kept * value - spent) * 100, spent, 0).alias("expected_roi"))


def roi_by_percent(df: DataFrame, ident: str, p: str = "churn_probability", percents: Sequence[int] = (10, 20, 30, 40, 50),
                   cost: float = 50.0, value: float = 1000.0, effectiveness: float = 0.3) -> DataFrame:
    """ROI when contacting the likeliest x percent: running sums read at those rows."""
    n = df.agg(F.count(F.lit(1))).scalar()
    run = running_totals(df.select(ident, p), p, {"rank": F.lit(1).cast("long"), "cum_p": F.col(p)}, tie=ident, descending=True)
    marks = F.array(*[F.lit(int(x)) for x in percents])
    hits = run.withColumn("n", n).withColumn("percent", F.explode(F.filter(marks, lambda x: F.floor(F.col("n") * x / F.lit(100)) == F.col("rank"))))
    revenue, spent = F.col("cum_p") * effectiveness * value, F.col("rank") * F.lit(cost)
    return hits.select("percent", F.col("rank").alias("n_contacts"), ratio((revenue - spent) * 100, spent, 0).alias("roi"))


def kpis(df: DataFrame, p: str = "churn_probability", high: float = 0.7, threshold: float = 0.5,
         params: BusinessParams = BusinessParams()) -> DataFrame:
    """Customers, high-risk count and share (strictly above), mean probability, net savings (with a label)."""
    n = F.count(F.lit(1))
    out = df.agg(n.alias("total_customers"), F.count_if(F.col(p) > high).alias("high_risk"),
                 (F.count_if(F.col(p) > high) * 100.0 / n).alias("high_risk_pct"), F.avg(p).alias("avg_risk"))
    if "label" not in df.columns:
        return out
    c = confusion(df, threshold, score=p)
    net = (F.col("tp") * F.lit(params.retention_value) - (F.col("tp") + F.col("fp")) * F.lit(params.contact_cost)
           + F.col("tp") * F.lit(params.churn_cost))
    return join_groups(out, c.select(net.alias("net_savings")), [])


def high_risk(df: DataFrame, ident: str, p: str = "churn_probability", threshold: float = 0.7, top: int = 100) -> DataFrame:
    return df.where(F.col(p) >= threshold).orderBy(F.col(p).desc(), ident).limit(top)


def with_clv(scores: DataFrame, clv: DataFrame, ident: str) -> DataFrame:
    """Scores with lifetime values; ids are compared as text."""
    right = clv.select(F.col(ident).cast("string").alias("_id"), *[c for c in clv.columns if c != ident])
    return scores.join(right, F.col(ident).cast("string") == F.col("_id"), "left").drop("_id")
