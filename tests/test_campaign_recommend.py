import pytest
from pyspark.sql import functions as F

from retenta.operators import campaign as P
from retenta.operators import recommend as R


@pytest.fixture(scope="module")
def ranked(spark):
    rows = [(i, (i % 10) / 10 + 0.05, float(i * 20)) for i in range(100)]
    df = spark.createDataFrame(rows, "customer_id long, churn_probability double, predicted_clv double")
    return P.rank_customers(df, "customer_id").cache()


def test_ranking_rules(ranked):
    rows = ranked.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 101))
    assert rows[0]["priority_score"] == 1.0 and rows[-1]["priority_score"] == 0.0
    eligible = [r for r in rows if r["eligible_for_intervention"]]
    assert all(r["expected_value"] > 0 and r["predicted_clv"] >= 100 and r["churn_probability"] >= 0.1 for r in eligible)
    assert all(r["priority_tier"] == "Low" for r in rows if not r["eligible_for_intervention"])
    assert sum(r["priority_tier"] == "High" for r in rows) == pytest.approx(0.2 * len(eligible), abs=1)


def test_flat_values_share_one_priority(spark):
    df = spark.createDataFrame([(1, 0.5, 500.0), (2, 0.5, 500.0)], "customer_id long, churn_probability double, predicted_clv double")
    assert {r["priority_score"] for r in P.rank_customers(df, "customer_id").collect()} == {0.5}


def test_budget(ranked):
    r = P.cost_benefit(ranked, "customer_id", budget=500.0).first()
    assert r["total_customers_targeted"] == 10 and r["total_cost"] == 500.0 and r["budget_utilization"] == 1.0
    assert r["break_even_customers"] == 1
    none = P.cost_benefit(ranked.where("not eligible_for_intervention"), "customer_id").first()
    assert none["total_customers_targeted"] == 0 and none["expected_roi"] == 0 and none["break_even_customers"] == 0


def test_campaign_kinds(spark):
    rows = [(1, 0.8, 2000.0), (2, 0.6, 600.0), (3, 0.35, 700.0), (4, 0.2, 5000.0)]
    df = spark.createDataFrame(rows, "customer_id long, churn_probability double, predicted_clv double")
    got = {r["customer_id"]: (r["urgency"], r["estimated_intervention_cost"]) for r in P.campaign_recommendations(P.rank_customers(df, "customer_id"), "customer_id").collect()}
    assert got == {1: ("Critical", 50.0), 2: ("High", 50.0), 3: ("Medium", 25.0), 4: ("Low", 25.0)}


EXPL = "id string, prediction double, top_features array<struct<feature:string,contribution:double>>"


def test_one_recommendation(spark):
    df = spark.createDataFrame([("c1", 0.75, [("monthly_charges", 0.3), ("tenure", -0.2), ("support_tickets", 0.15)])], EXPL)
    r = R.recommend(df, "id", spark.createDataFrame([("c1", 5000.0)], "id string, lifetime_value double")).first()
    assert r["risk_level"] == "High"
    assert r["primary_actions"] == ["Offer billing discount or payment plan", "Review service plan for cost optimization", "Provide value demonstration session"]
    assert r["secondary_actions"][3] == "Review billing and payment options" and len(r["secondary_actions"]) == 4
    assert r["priority_score"] == pytest.approx(0.75 + 0.75 * 0.2 * 3 / 10 + 0.15)
    assert r["confidence"] == pytest.approx(0.6 * 3 / 5 + 0.4 * 0.5)
    assert r["retention_improvement"] == pytest.approx(0.25) and r["expected_value"] == pytest.approx(200.0)
    assert r["explanation_summary"] == ("Customer has high churn risk (75.0% probability). Primary factor: monthly_charges increases churn risk. "
                                        "Other key factors: tenure, support_tickets.")


def test_unknown_features_give_no_primary_action(spark):
    df = spark.createDataFrame([("c", 0.1, [("other", 0.5)])], EXPL)
    r = R.recommend(df, "id").first()
    assert r["primary_actions"] == [] and r["expected_value"] == -50.0 and r["risk_level"] == "Low"
    a = R.business_alignment(R.recommend(df, "id"), "id").first()
    assert len(a["suggestions"]) == 2 and a["alignment_score"] == pytest.approx(0.8) and a["business_alignment"] == "good"


def test_quality_checks(spark):
    row = [("c", 0.86, [("tenure", 0.3), ("x", 0.05)], [("tenure", 0.3), ("x", 0.05)], [("tenure", -0.1), ("x", 0.2)])]
    s = "array<struct<feature:string,contribution:double>>"
    df = spark.createDataFrame(row, f"id string, prediction double, top_features {s}, attributions {s}, surrogate {s}")
    r = R.explanation_quality(df, "id").first()
    assert r["issues"] == ["Contradictory contributions for tenure: SHAP=1.0, LIME=-1.0"]
    assert r["warnings"] == ["Unexpected relationship for tenure: expected -1, got 1.0", "Explanation has fewer than 3 contributing features"]
    assert r["quality_score"] == pytest.approx(0.6) and r["overall_quality"] == "poor"


def test_campaign_segments(spark):
    df = spark.createDataFrame([("High", ["Urgent call"]), ("High", ["x"]), ("Medium", ["a discount"]), ("Medium", []), ("Low", [])], "r string, a array<string>")
    got = [x[0] for x in df.select(R.campaign_segment(F.col("r"), F.col("a"))).collect()]
    assert got == ["high_risk_immediate", "high_risk_engagement", "medium_risk_value", "medium_risk_proactive", "low_risk_monitoring"]
