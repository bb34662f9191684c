"""Profit, thresholds, lift, gains and savings over a scored DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from retenta.functions.expr import ratio
from retenta.params import BusinessParams
from retenta.plans.order import running_totals
from retenta.plans.scoretable import (
    SWEEP, confusion, join_groups, metric_set, rates, score_runs, threshold_confusion,
)

def _counts() -> tuple[Column, Column, Column, Column]:
    return F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn")


def profit(tp: Column, fp: Column, fn: Column, retention: Column, contact: Column, churn: Column) -> Column:
    return tp * retention - (tp + fp) * contact - fn * churn


def _prices(p: BusinessParams) -> tuple[Column, Column, Column]:
    return F.lit(p.retention_value), F.lit(p.contact_cost), F.lit(p.churn_cost)


def profit_curve(df: DataFrame, params: BusinessParams = BusinessParams(), thresholds: Sequence[float] = SWEEP,
                 by: Sequence[str] = ()) -> DataFrame:
    """Profit, precision, recall, F1 and counts per threshold."""
    tp, fp, tn, fn = _counts()
    table = threshold_confusion(df, thresholds, by)
    return table.select(*by, "threshold", profit(tp, fp, fn, *_prices(params)).alias("profit"),
                        *[c.alias(k) for k, c in rates(tp, fp, fn).items()], "tp", "fp", "tn", "fn")


def optimal_threshold(df: DataFrame, params: BusinessParams = BusinessParams(),
                      thresholds: Sequence[float] = SWEEP, by: Sequence[str] = ()) -> DataFrame:
    """The profit-maximising row of the curve; the lowest threshold wins ties."""
    curve = profit_curve(df, params, thresholds, by)
    names = [c for c in curve.columns if c not in by]
    best = F.max_by(F.struct(*names), F.struct(F.col("profit"), -F.col("threshold"))).alias("best")
    return curve.groupBy(*by).agg(best).select(*by, "best.*")


DEFAULT_RANGES = {
    "retention_value": (500.0, 750.0, 1000.0, 1250.0, 1500.0),
    "contact_cost": (25.0, 37.5, 50.0, 62.5, 75.0),
    "churn_cost": (250.0, 375.0, 500.0, 625.0, 750.0),
}


def sensitivity(df: DataFrame, params: BusinessParams = BusinessParams(),
                ranges: dict[str, Sequence[float]] = DEFAULT_RANGES, by: Sequence[str] = ()) -> DataFrame:
    """Best threshold when one parameter varies; all scenarios share one histogram."""
    scenarios = []
    for name, values in ranges.items():
        for v in values:
            prices = {f: F.lit(float(getattr(params, f))) for f in ("retention_value", "contact_cost", "churn_cost")}
            prices[name] = F.lit(float(v))
            scenarios.append(F.struct(F.lit(name).alias("parameter"), F.lit(float(v)).alias("parameter_value"),
                                      *[c.alias(f) for f, c in prices.items()]))
    tp, fp, tn, fn = _counts()
    table = threshold_confusion(df, SWEEP, by).withColumn("s", F.explode(F.array(*scenarios)))
    table = table.select(*by, "s.parameter", "s.parameter_value", "threshold",
                         profit(tp, fp, fn, F.col("s.retention_value"), F.col("s.contact_cost"),
                                F.col("s.churn_cost")).alias("profit"),
                         *[c.alias(k) for k, c in rates(tp, fp, fn).items()])
    best = F.max_by(F.struct("threshold", "profit", "precision", "recall", "f1"),
                    F.struct(F.col("profit"), -F.col("threshold"))).alias("b")
    return table.groupBy(*by, "parameter", "parameter_value").agg(best).select(
        *by, "parameter", "parameter_value", F.col("b.threshold").alias("optimal_threshold"),
        F.col("b.profit").alias("optimal_profit"), "b.precision", "b.recall", "b.f1")


def _expected_value_columns(params: BusinessParams) -> dict[str, Column]:
    tp, fp, tn, fn = _counts()
    total = tp + fp + tn + fn
    rv, cc, ch = _prices(params)
    value = profit(tp, fp, fn, rv, cc, ch)
    return {
        "total_profit": value,
        "profit_per_customer": ratio(value, total),
        "contact_rate": ratio(tp + fp, total),
        "retention_rate": ratio(tp, tp + fn, 0),
        "total_retention_revenue": tp * rv,
        "total_contact_costs": (tp + fp) * cc,
        "total_churn_costs": fn * ch,
        "customers_contacted": tp + fp,
        "customers_retained": tp,
        "customers_lost": fn,
        "true_positives": tp,
        "false_positives": fp,
        "true_negatives": tn,
        "false_negatives": fn,
    }


def expected_value(df: DataFrame, threshold: float, params: BusinessParams = BusinessParams(),
                   by: Sequence[str] = ()) -> DataFrame:
    table = confusion(df, threshold, by)
    cols = _expected_value_columns(params)
    return table.select(*by, F.lit(float(threshold)).alias("threshold"), *[c.alias(k) for k, c in cols.items()])


def compare_thresholds(df: DataFrame, thresholds: Sequence[float], params: BusinessParams = BusinessParams(),
                       by: Sequence[str] = ()) -> DataFrame:
    """Expected value at each threshold, most profitable first."""
    table = threshold_confusion(df, thresholds, by)
    cols = _expected_value_columns(params)
    out = table.select(*by, "threshold", *[c.alias(k) for k, c in cols.items()])
    return out.orderBy(F.col("total_profit").desc(), F.col("threshold"))


def savings_columns(params: BusinessParams, threshold: Column) -> dict[str, Column]:
    """The savings record from tp, fp, tn, fn.  Cost per retained customer is NULL when tp = 0."""
    tp, fp, tn, fn = _counts()
    rv, cc, ch = _prices(params)
    total, churners = tp + fp + tn + fn, tp + fn
    value = profit(tp, fp, fn, rv, cc, ch)
    net = value + churners * ch
    contact = (tp + fp) * cc
    return {
        "total_profit": value,
        "net_savings": net,
        "roi_percentage": ratio(net * 100, contact, 0),
        "retention_revenue": tp * rv,
        "total_contact_costs": contact,
        "missed_churn_costs": fn * ch,
        "baseline_churn_cost": churners * ch,
        "cost_per_retained_customer": ratio(contact, tp),
        "value_per_customer": ratio(net, total),
        "contact_rate": ratio(tp + fp, total),
        "retention_success_rate": ratio(tp, tp + fp, 0),
        "churn_prevention_rate": ratio(tp, churners, 0),
        "customers_contacted": tp + fp,
        "customers_retained": tp,
        "customers_lost": fn,
        "total_customers": total,
        "total_churners": churners,
        "true_positives": tp,
        "false_positives": fp,
        "true_negatives": tn,
        "false_negatives": fn,
        "retention_value_used": rv,
        "contact_cost_used": cc,
        "churn_cost_used": ch,
        "threshold_used": threshold,
    }


def expected_savings(df: DataFrame, threshold: float, params: BusinessParams = BusinessParams(),
                     by: Sequence[str] = ()) -> DataFrame:
    cols = savings_columns(params, F.lit(float(threshold)))
    return confusion(df, threshold, by).select(*by, *[c.alias(k) for k, c in cols.items()])


def value_metrics(df: DataFrame, threshold: float, params: BusinessParams = BusinessParams(),
                  by: Sequence[str] = ()) -> DataFrame:
    """Savings plus lifetime impact, rates, revenue per contact, margin and break-even rate."""
    tp, fp, tn, fn = _counts()
    rv, cc, ch = _prices(params)
    cols = savings_columns(params, F.lit(float(threshold)))
    r = rates(tp, fp, fn)
    cols |= {
        "clv_impact": tp * rv,
        "precision": r["precision"],
        "recall": r["recall"],
        "f1_score": r["f1"],
        "revenue_per_contact": ratio(tp * rv, tp + fp, 0),
        "profit_margin": ratio(cols["total_profit"], tp * rv, 0),
        "break_even_contact_rate": ratio(cc, rv, 0),
    }
    return confusion(df, threshold, by).select(*by, *[c.alias(k) for k, c in cols.items()])


def ranked_scores(df: DataFrame, ident: str, by: Sequence[str] = ()) -> DataFrame:
    """Rank from the highest score (ties by id) and positives seen so far."""
    narrow = df.select(*by, ident, "label", "score")
    return running_totals(narrow, "score", {"rank": F.lit(1).cast("long"), "cum_pos": F.col("label").cast("long")},
                          tie=ident, by=by, descending=True)


def lift_table(df: DataFrame, ident: str, deciles: int = 10) -> DataFrame:
    """Lift by score decile; every decile has floor(n/d) rows, the last takes the remainder."""
    size = F.floor(df.agg(F.count(F.lit(1))).scalar() / F.lit(deciles))
    ranked = ranked_scores(df, ident)
    place = F.when(size == 0, F.lit(deciles)).otherwise(
        F.least(F.floor((F.col("rank") - 1) / size) + 1, F.lit(deciles)))
    table = ranked.groupBy(place.cast("int").alias("decile")).agg(
        F.min("score").alias("threshold_min"), F.max("score").alias("threshold_max"),
        F.count(F.lit(1)).alias("n_customers"), F.sum(F.col("label").cast("long")).alias("n_churners"))
    # at most `deciles` rows from here on
    upto = W.orderBy("decile").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy()
    n, k = F.col("n_customers"), F.col("n_churners")
    overall = ratio(F.sum(k).over(whole), F.sum(n).over(whole))
    all_churners = F.sum(k).over(whole)
    return table.select(
        "decile", "threshold_min", "threshold_max", "n_customers", "n_churners",
        ratio(k, n, 0).alias("churn_rate"),
        ratio(ratio(k, n, 0), overall, 0).alias("lift"),
        ratio(ratio(F.sum(k).over(upto), F.sum(n).over(upto), 0), overall, 0).alias("cumulative_lift"),
        ratio(k, all_churners, 0).alias("capture_rate"),
        ratio(F.sum(k).over(upto), all_churners, 0).alias("cumulative_capture_rate"),
    )


def gains_curve(df: DataFrame, ident: str) -> DataFrame:
    """Share of population against share of positives captured, one point per row."""
    totals = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("p")).alias("t"))
    ranked = ranked_scores(df, ident).withColumn("t", totals.scalar())
    return ranked.select(
        ident, "rank", F.col("cum_pos").alias("cumulative_positives"),
        (F.col("rank") / F.col("t.n") * 100).alias("population_percentage"),
        ratio(F.col("cum_pos") * 100, F.col("t.p")).alias("gains_percentage"),
    )


def gains_marks(df: DataFrame, ident: str, percents: Sequence[int] = (10, 20, 30, 50)) -> DataFrame:
    """Gains at given population percentages (row floor(n * pct / 100))."""
    n = df.agg(F.count(F.lit(1))).scalar()
    marks = F.array(*[F.lit(int(p)) for p in percents])
    curve = gains_curve(df, ident).withColumn("n", n)
    hits = curve.withColumn("percent", F.explode(F.filter(
        marks, lambda p: F.floor(F.col("n") * p / F.lit(100)) == F.col("rank"))))
    return hits.select("percent", F.col("rank").alias("n_contacted"), "cumulative_positives", "gains_percentage")


def decile_profit(df: DataFrame, ident: str, params: BusinessParams = BusinessParams(), deciles: int = 10) -> DataFrame:
    """Savings when contacting everyone at or above each decile's lowest score."""
    lift = lift_table(df, ident, deciles).select("decile", F.col("threshold_min").alias("score"), "lift", "capture_rate")
    runs = score_runs(df).select("score", "cum_n", "cum_pos")
    at = lift.join(runs, "score")
    cells = at.withColumns({"tp": F.col("cum_pos"), "fp": F.col("cum_n") - F.col("cum_pos"),
                            "tn": F.lit(0), "fn": F.lit(0)})
    cols = savings_columns(params, F.col("score"))
    return cells.select("decile", F.col("score").alias("threshold"), "lift", "capture_rate",
                        cols["customers_contacted"].alias("customers_contacted"),
                        cols["total_profit"].alias("expected_profit"),
                        cols["roi_percentage"].alias("roi_percentage"),
                        cols["cost_per_retained_customer"].alias("cost_per_retained"))


def decile_summary(df: DataFrame, ident: str, params: BusinessParams = BusinessParams(), deciles: int = 10) -> DataFrame:
    t = decile_profit(df, ident, params, deciles)
    d = F.col("decile")

    def top(k: int) -> Column:
        return F.sum(F.when(d <= k, F.col("capture_rate")).otherwise(F.lit(0.0)))

    return t.agg(
        F.max("lift").alias("best_decile_lift"), F.min("lift").alias("worst_decile_lift"),
        top(3).alias("top_3_deciles_capture"), top(5).alias("top_5_deciles_capture"),
        top(2).alias("concentration_ratio"),
        F.max_by(d, F.struct(F.col("expected_profit"), -d)).alias("optimal_profit_decile"),
        F.max_by(d, F.struct(F.col("roi_percentage"), -d)).alias("optimal_roi_decile"),
        F.max("expected_profit").alias("max_expected_profit"), F.max("roi_percentage").alias("max_roi_percentage"),
    )


def capture_rates(df: DataFrame, ident: str, percents: Sequence[float] = (5, 10, 15, 20, 25, 30, 40, 50),
                  params: BusinessParams = BusinessParams()) -> DataFrame:
    """Captured churners when contacting the top x percent.

    The savings columns apply the score of the last contacted row as a
    threshold, so rows tied with it count there but not as captured.
    """
    totals = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("p")).alias("t"))
    marks = F.array(*[F.lit(float(p)) for p in percents])
    ranked = ranked_scores(df, ident).withColumn("t", totals.scalar())
    hits = ranked.withColumn("contact_percentage", F.explode(F.filter(
        marks, lambda p: F.floor(F.col("t.n") * p / F.lit(100)) == F.col("rank"))))
    runs = score_runs(df).select("score", "cum_n", F.col("cum_pos").alias("at_or_above"))
    at = hits.join(runs, "score").withColumns({
        "tp": F.col("at_or_above"), "fp": F.col("cum_n") - F.col("at_or_above"),
        "fn": F.col("t.p") - F.col("at_or_above"),
        "tn": F.col("t.n") - F.col("cum_n") - F.col("t.p") + F.col("at_or_above"),
    })
    cols = savings_columns(params, F.col("score"))
    return at.select(
        "contact_percentage", F.col("rank").alias("customers_contacted"), F.col("cum_pos").alias("churners_captured"),
        ratio(F.col("cum_pos"), F.col("t.p"), 0).alias("capture_rate"), F.col("score").alias("threshold"),
        cols["total_profit"].alias("expected_profit"), cols["roi_percentage"].alias("roi_percentage"),
        cols["total_contact_costs"].alias("contact_cost"), cols["retention_revenue"].alias("retention_revenue"))


def model_comparison(df: DataFrame, model: str = "model", threshold: float = 0.5) -> DataFrame:
    """Metric set per model, best ROC-AUC first."""
    m = metric_set(df, [model], threshold)
    return m.select(model, "roc_auc", "pr_auc", "brier_score", "log_loss", "accuracy", "precision", "recall",
                    "f1").orderBy(F.col("roc_auc").desc(), model)


def business_impact(df: DataFrame, model: str = "model", threshold: float = 0.5,
                    params: BusinessParams = BusinessParams()) -> DataFrame:
    """Savings record per model, most profitable first."""
    return expected_savings(df, threshold, params, [model]).orderBy(F.col("total_profit").desc(), model)


def roc_curve(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC points at distinct scores."""
    return _curve(df, by).select(*by, F.col("score").alias("threshold"),
                                 ratio(F.col("cum_n") - F.col("cum_pos"), F.col("n_neg")).alias("fpr"),
                                 ratio(F.col("cum_pos"), F.col("n_pos")).alias("tpr"))


def pr_curve(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at distinct scores, with the positive share as baseline."""
    return _curve(df, by).select(*by, F.col("score").alias("threshold"),
                                 ratio(F.col("cum_pos"), F.col("cum_n")).alias("precision"),
                                 ratio(F.col("cum_pos"), F.col("n_pos")).alias("recall"),
                                 ratio(F.col("n_pos"), F.col("n_pos") + F.col("n_neg")).alias("baseline"))


def _curve(df: DataFrame, by: Sequence[str]) -> DataFrame:
    totals = df.groupBy(*by).agg(F.sum(F.col("label").cast("long")).alias("n_pos"),
                                 F.sum(1 - F.col("label").cast("long")).alias("n_neg"))
    return join_groups(score_runs(df, by), totals, by)


def executive_summary(df: DataFrame, model: str = "model", params: BusinessParams = BusinessParams(),
                      threshold: float = 0.5) -> DataFrame:
    """One row: best model by AUC with its impact, profit range and best ROI over models."""
    auc = metric_set(df, [model], threshold).select(model, "roc_auc")
    money = expected_savings(df, threshold, params, [model])
    t = auc.join(money, model)
    first = F.struct(F.coalesce(-F.col("roc_auc"), F.lit(float("inf"))), F.col(model))  # ties to the smaller name

    def best(c: str) -> Column:
        return F.min_by(c, first)

    return t.agg(
        best(model).alias("best_model"), F.max("roc_auc").alias("best_roc_auc"),
        best("total_profit").alias("best_model_profit"), best("roi_percentage").alias("best_model_roi"),
        best("contact_rate").alias("best_model_contact_rate"),
        F.min("total_profit").alias("min_profit"), F.max("total_profit").alias("max_profit"),
        F.max("roi_percentage").alias("max_roi"), F.count(F.lit(1)).alias("n_models"),
    )
