"""Business recommendations from local explanations, as row expressions.

Input rows: an id, `prediction`, and `top_features`, an array of
struct<feature, contribution> ordered by absolute contribution.  Nothing here
shuffles except the summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F



# fixed values: actions per feature, (lowers the risk, keeps a strength)
FEATURE_ACTIONS = {
    "monthly_charges": (
        ("Offer billing discount or payment plan", "Review service plan for cost optimization", "Provide value demonstration session"),
        ("Highlight value received for current spend", "Offer loyalty rewards program")),
    "total_charges": (
        ("Offer retention credit", "Review historical usage for optimization"),
        ("Acknowledge customer loyalty", "Offer premium service benefits")),
    "tenure": (
        ("Provide new customer onboarding support", "Offer extended trial period"),
        ("Celebrate customer milestone", "Offer long-term customer benefits")),
    "contract": (
        ("Offer contract flexibility options", "Provide contract renewal incentives"),
        ("Highlight contract benefits", "Offer contract upgrade options")),
    "support_tickets": (
        ("Improve support response time", "Assign dedicated support representative", "Provide proactive support check-ins"),
        ("Maintain current support quality", "Offer premium support upgrade")),
}
# fixed values: actions per risk level
RISK_ACTIONS = {
    "High": ("Schedule immediate customer success call", "Offer premium support upgrade", "Provide executive escalation contact"),
    "Medium": ("Send proactive engagement email", "Offer product training session", "Schedule quarterly business review"),
    "Low": ("Include in customer satisfaction survey", "Send product update newsletter", "Monitor usage patterns"),
}
# fixed values: feature classes by keyword, first match wins, and the extra action of a class
FEATURE_CLASSES = (
    ("usage", ("usage", "activity", "login", "session")),
    ("billing", ("charge", "payment", "bill", "cost")),
    ("support", ("support", "ticket", "complaint")),
    ("service", ("service", "feature", "product")),
)
CLASS_ACTIONS = (
    ("usage", "Provide usage optimization recommendations"),
    ("billing", "Review billing and payment options"),
    ("support", "Improve support experience"),
)
# fixed values: effectiveness of an action by keyword, first match wins
EFFECTIVENESS = (("discount", 0.15), ("support", 0.10), ("engagement", 0.08))
DEFAULT_EFFECTIVENESS, EFFECTIVENESS_CAP, CUSTOMER_VALUE, CONTACT_COST = 0.05, 0.5, 1000.0, 50.0
# fixed values: expected sign of a feature's contribution
EXPECTED_SIGNS = {"monthly_charges": 1, "tenure": -1, "total_charges": 1, "contract_month_to_month": 1,
                  "payment_method_electronic_check": 1, "internet_service_fiber_optic": -1}
# fixed values: action intensity keywords
HIGH_INTENSITY = ("immediate", "urgent", "discount", "credit")
LOW_INTENSITY = ("monitor", "survey", "newsletter")
# fixed values: action lists of the scoring view by risk band, and the extra hint by probability
BAND_ACTIONS = {
    "High": ("Immediate Action Required", "Contact customer within 24 hours", "Offer retention discount or upgrade",
             "Assign to senior customer success manager", "Conduct satisfaction survey"),
    "Medium": ("Monitor Closely", "Send personalized engagement email", "Offer loyalty rewards or benefits",
               "Increase touchpoint frequency", "Analyze usage patterns for intervention opportunities"),
    "Low": ("Low Risk - Maintain Engagement", "Include in regular newsletter campaigns", "Encourage referrals and reviews",
            "Suggest product upgrades when appropriate", "Monitor for any changes in behavior"),
}
BAND_HINTS = ((0.8, "Consider offering a significant discount or free trial extension"),
              (0.6, "Schedule a check-in call to understand pain points"),
              (None, "Focus on upselling and cross-selling opportunities"))


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.lit(None).cast("array<string>")


def _has_any(text: Column, words) -> Column:
    out = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(text, F.lit(w))
    return out


def risk_level(p: Column, high: float = 0.7, medium: float = 0.3) -> Column:
    return F.when(p >= high, "High").when(p >= medium, "Medium").otherwise("Low")


def primary_actions(top: Column) -> Column:
    """Actions of the five strongest features by sign of contribution, distinct in order, first three."""
    none = F.lit(None).cast("array<string>")

    def actions(f: Column) -> Column:
        out = none
        for name, (lower, keep) in FEATURE_ACTIONS.items():
            out = F.when(f["feature"] == name, F.when(f["contribution"] > 0, _texts(lower)).otherwise(_texts(keep))).otherwise(out)
        return F.coalesce(out, F.array().cast("array<string>"))

    return F.slice(F.array_distinct(F.flatten(F.transform(F.slice(top, 1, 5), actions))), 1, 3)


def feature_class(name: Column) -> Column:
    low = F.lower(name)
    out = F.lit(None).cast("string")
    for cls, words in reversed(FEATURE_CLASSES):
        out = F.when(_has_any(low, words), F.lit(cls)).otherwise(out)
    return out


def secondary_actions(risk: Column, top: Column) -> Column:
    """Three actions of the risk level plus those of the feature classes present; first four."""
    base = F.when(risk == "High", _texts(RISK_ACTIONS["High"])).when(risk == "Medium", _texts(RISK_ACTIONS["Medium"])).otherwise(
        _texts(RISK_ACTIONS["Low"]))
    classes = F.transform(top, lambda f: F.coalesce(feature_class(f["feature"]), F.lit("")))
    extras = F.array_compact(F.array(*[
        F.when(F.array_contains(classes, cls), F.lit(action)) for cls, action in CLASS_ACTIONS]))
    return F.slice(F.concat(base, extras), 1, 4)


def priority(p: Column, top: Column, value: Column | None = None) -> Column:
    bonus = F.lit(0.0)
    if value is not None:
        bonus = F.when(value > 0, F.least(value / 10000, F.lit(1.0)) * 0.3).otherwise(F.lit(0.0))
    return F.least(p + p * 0.2 * F.size(top) / 10 + bonus, F.lit(1.0))


def confidence(p: Column, top: Column) -> Column:
    strong = F.size(F.filter(top, lambda f: F.abs(f["contribution"]) > 0.1))
    return F.least(strong / F.lit(5.0), F.lit(1.0)) * 0.6 + F.abs(p - 0.5) * 2 * 0.4


def effectiveness(actions: Column) -> Column:
    def one(a: Column) -> Column:
        out = F.lit(DEFAULT_EFFECTIVENESS)
        for word, v in reversed(EFFECTIVENESS):
            out = F.when(F.contains(F.lower(a), F.lit(word)), F.lit(v)).otherwise(out)
        return out

    return F.least(F.aggregate(actions, F.lit(0.0), lambda acc, a: acc + one(a)), F.lit(EFFECTIVENESS_CAP))


def percent_text(p: Column) -> Column:
    return F.format_string("%.1f%%", F.rint(p * 1000) / 10)


def summary_text(p: Column, top: Column) -> Column:
    """Risk sentence, primary factor, and up to two other factors."""
    head = F.concat(F.lit("Customer has "), F.lower(risk_level(p)), F.lit(" churn risk ("), percent_text(p), F.lit(" probability)."))
    first = F.get(top, F.lit(0))
    main = F.concat(F.lit("Primary factor: "), first["feature"], F.when(first["contribution"] > 0, " increases").otherwise(" decreases"),
                    F.lit(" churn risk."))
    others = F.concat(F.lit("Other key factors: "), F.array_join(F.transform(F.slice(top, 2, 2), lambda f: f["feature"]), ", "), F.lit("."))
    return F.concat_ws(" ", head, F.when(F.size(top) > 0, main), F.when(F.size(top) > 1, others))


def recommend(explanations: DataFrame, ident: str, values: DataFrame | None = None) -> DataFrame:
    """One recommendation row per explanation; `values` (id, lifetime_value) adds the value bonus where known."""
    df = explanations
    value = None
    if values is not None:
        df = df.join(values.select(ident, "lifetime_value"), ident, "left")
        value = F.col("lifetime_value")
    p, top = F.col("prediction"), F.col("top_features")
    out = df.select(
        ident, p.alias("churn_probability"), risk_level(p).alias("risk_level"), primary_actions(top).alias("primary_actions"),
        secondary_actions(risk_level(p), top).alias("secondary_actions"), priority(p, top, value).alias("priority_score"),
        summary_text(p, top).alias("explanation_summary"), confidence(p, top).alias("confidence"))
    eff = effectiveness(F.col("primary_actions"))
    return out.withColumns({
        "retention_improvement": eff, "expected_value": eff * CUSTOMER_VALUE - CONTACT_COST,
        "potential_revenue": eff * CUSTOMER_VALUE, "contact_cost": F.lit(CONTACT_COST)})


def prioritise(recs: DataFrame, ident: str, max_contacts: int | None = None) -> DataFrame:
    out = recs.orderBy(F.col("priority_score").desc(), ident)
    return out.limit(max_contacts) if max_contacts else out


def campaign_segment(risk: Column, actions: Column) -> Column:
    def any_word(*words: str) -> Column:
        return F.exists(actions, lambda a: _has_any(F.lower(a), words))

    return F.when(risk == "High", F.when(any_word("immediate", "urgent"), "high_risk_immediate").otherwise("high_risk_engagement")).when(
        risk == "Medium", F.when(any_word("value", "discount"), "medium_risk_value").otherwise("medium_risk_proactive")).otherwise(
        "low_risk_monitoring")


def with_campaign_segment(recs: DataFrame) -> DataFrame:
    return recs.withColumn("campaign_segment", campaign_segment(F.col("risk_level"), F.col("primary_actions")))


def campaign_summary(recs: DataFrame) -> DataFrame:
    """Per campaign segment: size, means, summed expected value, three commonest actions (ties by name)."""
    r = with_campaign_segment(recs)
    g = r.groupBy("campaign_segment").agg(
        F.count(F.lit(1)).alias("count"), F.avg("churn_probability").alias("avg_churn_probability"),
        F.avg("priority_score").alias("avg_priority_score"), F.avg("confidence").alias("avg_confidence"),
        F.sum("expected_value").alias("estimated_impact"))
    acts = r.select("campaign_segment", F.explode("primary_actions").alias("action")).groupBy("campaign_segment", "action").agg(
        F.count(F.lit(1)).alias("k"))
    order = W.partitionBy("campaign_segment").orderBy(F.col("k").desc(), "action")  # one row per known action
    top = acts.withColumn("rn", F.row_number().over(order)).where("rn <= 3").groupBy("campaign_segment").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rn", "action"))), lambda s: s["action"]).alias("top_actions"))
    total = r.agg(F.count(F.lit(1))).scalar()
    return g.join(top, "campaign_segment", "left").withColumn("percentage", F.col("count") * 100.0 / total)


def campaign_overall(recs: DataFrame) -> DataFrame:
    return recs.agg(F.count(F.lit(1)).alias("total_customers"), F.avg("churn_probability").alias("avg_churn_probability"),
                    F.avg("priority_score").alias("avg_priority_score"), F.sum("expected_value").alias("estimated_total_impact"))


def _verdict(bad: Column, mild: Column) -> Column:
    return F.when(F.size(bad) > 0, "poor").when(F.size(mild) > 2, "fair").otherwise("good")


def explanation_quality(df: DataFrame, ident: str) -> DataFrame:
    """Checks over prediction, top_features, attributions and surrogate (arrays of struct<feature, contribution>).

    Issues: attribution and surrogate disagree in sign (where |attribution| > 0.01);
    0.5 + sum of attributions misses the prediction by more than 0.05.
    Warnings: unexpected sign among the top five, fewer than three features, tiny contributions.
    """
    p, top, att, sur = (F.col(c) for c in ("prediction", "top_features", "attributions", "surrogate"))

    def conflict(f: Column) -> Column:
        other = F.get(F.filter(sur, lambda g: g["feature"] == f["feature"]), F.lit(0))["contribution"]
        a, b = F.signum(f["contribution"]), F.signum(other)
        return F.when((a != b) & (F.abs(f["contribution"]) > 0.01), F.concat(
            F.lit("Contradictory contributions for "), f["feature"], F.lit(": SHAP="), a.cast("string"), F.lit(", LIME="), b.cast("string")))

    conflicts = F.when(F.size(att) > 0, F.array_compact(F.transform(att, conflict)))
    total = F.aggregate(att, F.lit(0.0), lambda acc, f: acc + f["contribution"]) + 0.5
    additivity = F.when((F.size(att) > 0) & (F.abs(total - p) > 0.05), F.array(F.concat(
        F.lit("SHAP additivity violated: expected "), F.format_string("%.3f", total), F.lit(", got "), F.format_string("%.3f", p))))

    def surprise(f: Column) -> Column:
        expected = F.lit(None).cast("int")
        for name, sign in EXPECTED_SIGNS.items():
            expected = F.when(f["feature"] == name, F.lit(sign)).otherwise(expected)
        got = F.signum(f["contribution"])
        return F.when(expected.cast("double") != got, F.concat(
            F.lit("Unexpected relationship for "), f["feature"], F.lit(": expected "), expected.cast("string"), F.lit(", got "), got.cast("string")))

    strength = F.aggregate(top, F.lit(0.0), lambda acc, f: acc + F.abs(f["contribution"]))
    none = F.array().cast("array<string>")
    issues = F.concat(F.coalesce(conflicts, none), F.coalesce(additivity, none))
    warnings = F.concat(
        F.array_compact(F.transform(F.slice(top, 1, 5), surprise)),
        F.array_compact(F.array(
            F.when(F.size(top) < 3, F.lit("Explanation has fewer than 3 contributing features")),
            F.when(strength < 0.1, F.lit("Feature contributions are very small, explanation may be unreliable")))))
    out = df.select(ident, issues.alias("issues"), warnings.alias("warnings"))
    score = F.greatest(F.lit(0.0), 1.0 - F.size("issues") * 0.2 - F.size("warnings") * 0.1)
    return out.withColumns({"quality_score": score, "overall_quality": _verdict(F.col("issues"), F.col("warnings"))})


def business_alignment(recs: DataFrame, ident: str) -> DataFrame:
    """Intensity against risk (issues); value, number and conflict of actions (suggestions)."""
    risk, acts, ev = F.col("risk_level"), F.col("primary_actions"), F.col("expected_value")

    def clash(a: Column) -> Column:
        low = F.lower(a)
        return F.when((risk == "Low") & _has_any(low, HIGH_INTENSITY), F.concat(
            F.lit("High-intensity action '"), a, F.lit("' not appropriate for low-risk customer"))).when(
            (risk == "High") & _has_any(low, LOW_INTENSITY), F.concat(
                F.lit("Low-intensity action '"), a, F.lit("' insufficient for high-risk customer")))

    both = F.concat(acts, F.col("secondary_actions"))
    text = F.lower(F.array_join(both, " "))
    suggestions = F.array_compact(F.array(
        F.when(ev < 0, F.lit("Negative expected value - consider less costly actions")),
        F.when((ev < 100) & (risk == "Low"), F.lit("Low expected value for low-risk customer - consider monitoring only")),
        F.when(F.size(both) > 6, F.lit("Too many recommended actions - prioritize top 3-4 actions")),
        F.when(_has_any(text, ("discount",)) & _has_any(text, ("upgrade",)),
               F.lit("Conflicting actions: offering both discount and upgrade"))))
    out = recs.select(ident, F.array_compact(F.transform(acts, clash)).alias("issues"), suggestions.alias("suggestions"))
    score = F.greatest(F.lit(0.0), 1.0 - F.size("issues") * 0.3 - F.size("suggestions") * 0.1)
    return out.withColumns({"alignment_score": score, "business_alignment": _verdict(F.col("issues"), F.col("suggestions"))})


def band_actions(df: DataFrame, band: str = "risk_level", p: str = "churn_probability") -> DataFrame:
    """Fixed action list by risk band plus one hint by probability."""
    lists = F.when(F.col(band) == "High", _texts(BAND_ACTIONS["High"])).when(F.col(band) == "Medium", _texts(BAND_ACTIONS["Medium"])).otherwise(
        _texts(BAND_ACTIONS["Low"]))
    hint = F.lit(BAND_HINTS[-1][1])
    for limit, text in reversed(BAND_HINTS[:-1]):
        hint = F.when(F.col(p) > limit, F.lit(text)).otherwise(hint)
    return df.withColumns({"actions": lists, "hint": hint})
