"""Thresholds, profit, lift, gains and model comparison over the scored customers."""

from pyspark.sql import functions as F

from retenta.operators import business as B
from retenta.plans.scoretable import calibration_bins, calibration_errors, metric_set
from workload.base import SCORED_SQL, TWO_MODELS_SQL, scored, two_models
from workload.registry import query

WITH = "WITH " + SCORED_SQL
WITH2 = "WITH " + TWO_MODELS_SQL

SWEEP_SQL = """,
marks AS (SELECT round(i * 1e-2, 2) AS threshold FROM range(1, 100) r(i)),
grid AS (
  SELECT {by} threshold,
         sum(CASE WHEN label = 1 AND score >= threshold THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN label = 0 AND score >= threshold THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN label = 0 AND score < threshold THEN 1 ELSE 0 END) AS tn,
         sum(CASE WHEN label = 1 AND score < threshold THEN 1 ELSE 0 END) AS fn
  FROM {src}, marks GROUP BY {by} threshold
),
curve AS (
  SELECT *, tp * 1000e0 - (tp + fp) * 50e0 - fn * 500e0 AS profit,
         coalesce(tp / nullif(tp + fp, 0), 0) AS "precision", coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
         coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
  FROM grid
)
"""
ONE = SWEEP_SQL.format(by="", src="scored")
EACH = SWEEP_SQL.format(by="model, ", src="models")

CONF_SQL = """,
conf AS (
  SELECT {by} sum(CASE WHEN label = 1 AND score >= 5e-1 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN label = 0 AND score >= 5e-1 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN label = 0 AND score < 5e-1 THEN 1 ELSE 0 END) AS tn,
         sum(CASE WHEN label = 1 AND score < 5e-1 THEN 1 ELSE 0 END) AS fn
  FROM {src} {group}
)
"""
CONF = CONF_SQL.format(by="", src="scored", group="")
CONF2 = CONF_SQL.format(by="model,", src="models", group="GROUP BY model")

EV_FIELDS = """
  tp*1000e0 - (tp+fp)*50e0 - fn*500e0 AS total_profit,
  (tp*1000e0 - (tp+fp)*50e0 - fn*500e0) / (tp+fp+tn+fn) AS profit_per_customer,
  (tp+fp) / (tp+fp+tn+fn) AS contact_rate, coalesce(tp / nullif(tp+fn, 0), 0) AS retention_rate,
  tp*1000e0 AS total_retention_revenue, (tp+fp)*50e0 AS total_contact_costs, fn*500e0 AS total_churn_costs,
  tp+fp AS customers_contacted, tp AS customers_retained, fn AS customers_lost,
  tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives"""
EV_REAL = ("total_profit profit_per_customer contact_rate retention_rate total_retention_revenue "
           "total_contact_costs total_churn_costs")
EV_WHOLE = ("customers_contacted customers_retained customers_lost true_positives false_positives "
            "true_negatives false_negatives")

SAVINGS_FIELDS = """
  tp*1000e0 - (tp+fp)*50e0 - fn*500e0 AS total_profit,
  tp*1000e0 - (tp+fp)*50e0 + tp*500e0 AS net_savings,
  coalesce((tp*1000e0 - (tp+fp)*50e0 + tp*500e0) * 100 / nullif((tp+fp)*50e0, 0), 0) AS roi_percentage,
  tp*1000e0 AS retention_revenue, (tp+fp)*50e0 AS total_contact_costs, fn*500e0 AS missed_churn_costs,
  (tp+fn)*500e0 AS baseline_churn_cost, (tp+fp)*50e0 / nullif(tp, 0) AS cost_per_retained_customer,
  (tp*1000e0 - (tp+fp)*50e0 + tp*500e0) / (tp+fp+tn+fn) AS value_per_customer,
  (tp+fp) / (tp+fp+tn+fn) AS contact_rate, coalesce(tp / nullif(tp+fp, 0), 0) AS retention_success_rate,
  coalesce(tp / nullif(tp+fn, 0), 0) AS churn_prevention_rate,
  tp+fp AS customers_contacted, tp AS customers_retained, fn AS customers_lost, tp+fp+tn+fn AS total_customers,
  tp+fn AS total_churners, tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
  1000e0 AS retention_value_used, 50e0 AS contact_cost_used, 500e0 AS churn_cost_used, 5e-1 AS threshold_used"""
SAVINGS_REAL = ("total_profit net_savings roi_percentage retention_revenue total_contact_costs missed_churn_costs "
                "baseline_churn_cost cost_per_retained_customer value_per_customer contact_rate retention_success_rate "
                "churn_prevention_rate retention_value_used contact_cost_used churn_cost_used threshold_used")
SAVINGS_WHOLE = EV_WHOLE + " total_customers total_churners"

RANKED = """,
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, customer_id) AS rank,
         sum(label) OVER (ORDER BY score DESC, customer_id ROWS UNBOUNDED PRECEDING) AS cum_pos,
         count(*) OVER () AS n, sum(label) OVER () AS p
  FROM scored
)
"""
LIFT = RANKED + """,
deciles AS (
  SELECT least((rank - 1) // (n // 10) + 1, 10) AS decile, min(score) AS threshold_min, max(score) AS threshold_max,
         count(*) AS n_customers, sum(label) AS n_churners
  FROM ranked GROUP BY 1
),
lift AS (
  SELECT CAST(decile AS INTEGER) AS decile, threshold_min, threshold_max, n_customers, n_churners,
         n_churners / n_customers AS churn_rate,
         (n_churners / n_customers) / (sum(n_churners) OVER () / sum(n_customers) OVER ()) AS lift,
         (sum(n_churners) OVER w / sum(n_customers) OVER w) / (sum(n_churners) OVER () / sum(n_customers) OVER ()) AS cumulative_lift,
         n_churners / sum(n_churners) OVER () AS capture_rate,
         sum(n_churners) OVER w / sum(n_churners) OVER () AS cumulative_capture_rate
  FROM deciles WINDOW w AS (ORDER BY decile ROWS UNBOUNDED PRECEDING)
)
"""
DECILE_PROFIT = LIFT + """,
decile_profit AS (
  SELECT decile, threshold_min AS threshold, any_value(lift) AS lift, any_value(capture_rate) AS capture_rate,
         count(*) AS customers_contacted, sum(label)*1000e0 - count(*)*50e0 AS expected_profit,
         (sum(label)*1000e0 - count(*)*50e0 + sum(label)*500e0) * 100 / (count(*)*50e0) AS roi_percentage,
         count(*)*50e0 / nullif(sum(label), 0) AS cost_per_retained
  FROM lift JOIN scored ON score >= threshold_min GROUP BY decile, threshold_min
)
"""


@query("profit_curve", WITH2 + EACH + "SELECT model, threshold, profit, \"precision\", recall, f1, tp, fp, tn, fn FROM curve",
       real="threshold profit precision recall f1", whole="tp fp tn fn")
def profit_curve(t):
    return B.profit_curve(two_models(t), by=["model"])


@query("optimal_threshold", WITH + ONE + """SELECT threshold, profit, "precision", recall, f1, tp, fp, tn, fn FROM curve
  ORDER BY profit DESC, threshold LIMIT 1""",
       real="threshold profit precision recall f1", whole="tp fp tn fn")
def optimal_threshold(t):
    return B.optimal_threshold(scored(t))


@query("threshold_sensitivity", WITH + ONE + """,
scen AS (
  SELECT 'retention_value' AS parameter, v AS parameter_value, v AS rv, 50e0 AS cc, 500e0 AS ch
  FROM (VALUES (500e0), (750e0), (1000e0), (1250e0), (1500e0)) x(v)
  UNION ALL SELECT 'contact_cost', v, 1000e0, v, 500e0 FROM (VALUES (25e0), (37.5e0), (50e0), (62.5e0), (75e0)) x(v)
  UNION ALL SELECT 'churn_cost', v, 1000e0, 50e0, v FROM (VALUES (250e0), (375e0), (500e0), (625e0), (750e0)) x(v)
),
valued AS (
  SELECT parameter, parameter_value, threshold, tp*rv - (tp+fp)*cc - fn*ch AS pr, "precision", recall, f1,
         row_number() OVER (PARTITION BY parameter, parameter_value ORDER BY tp*rv - (tp+fp)*cc - fn*ch DESC, threshold) AS k
  FROM curve, scen
)
SELECT parameter, parameter_value, threshold AS optimal_threshold, pr AS optimal_profit, "precision", recall, f1
FROM valued WHERE k = 1""", real="parameter_value optimal_threshold optimal_profit precision recall f1")
def threshold_sensitivity(t):
    return B.sensitivity(scored(t))


@query("expected_value", WITH + CONF + f"SELECT 5e-1 AS threshold, {EV_FIELDS} FROM conf",
       real="threshold " + EV_REAL, whole=EV_WHOLE)
def expected_value(t):
    return B.expected_value(scored(t), 0.5)


@query("compare_thresholds", WITH + ONE + f"SELECT threshold, {EV_FIELDS} FROM grid WHERE threshold IN (3e-1, 5e-1, 7e-1)",
       real="threshold " + EV_REAL, whole=EV_WHOLE)
def compare_thresholds(t):
    return B.compare_thresholds(scored(t), [0.3, 0.5, 0.7])


@query("expected_savings", WITH + CONF + f"SELECT {SAVINGS_FIELDS} FROM conf", real=SAVINGS_REAL, whole=SAVINGS_WHOLE)
def expected_savings(t):
    return B.expected_savings(scored(t), 0.5)


@query("value_metrics", WITH + CONF + f"""SELECT {SAVINGS_FIELDS}, tp*1000e0 AS clv_impact,
  coalesce(tp / nullif(tp+fp, 0), 0) AS "precision", coalesce(tp / nullif(tp+fn, 0), 0) AS recall,
  coalesce(2e0 * tp / nullif(2*tp+fp+fn, 0), 0) AS f1_score,
  coalesce(tp*1000e0 / nullif(tp+fp, 0), 0) AS revenue_per_contact,
  coalesce((tp*1000e0 - (tp+fp)*50e0 - fn*500e0) / nullif(tp*1000e0, 0), 0) AS profit_margin,
  50e0 / 1000e0 AS break_even_contact_rate FROM conf""",
       real=SAVINGS_REAL + " clv_impact precision recall f1_score revenue_per_contact profit_margin break_even_contact_rate",
       whole=SAVINGS_WHOLE)
def value_metrics(t):
    return B.value_metrics(scored(t), 0.5)


@query("lift_table", WITH + LIFT + "SELECT * FROM lift",
       real="threshold_min threshold_max churn_rate lift cumulative_lift capture_rate cumulative_capture_rate",
       whole="n_customers n_churners")
def lift_table(t):
    return B.lift_table(scored(t), "customer_id")


@query("gains_curve", WITH + RANKED + """SELECT customer_id, rank, cum_pos AS cumulative_positives,
  rank / n * 100 AS population_percentage, cum_pos * 100 / p AS gains_percentage FROM ranked""",
       real="population_percentage gains_percentage", whole="rank cumulative_positives")
def gains_curve(t):
    return B.gains_curve(scored(t), "customer_id")


@query("gains_marks", WITH + RANKED + """SELECT pct AS percent, rank AS n_contacted, cum_pos AS cumulative_positives,
  cum_pos * 100 / p AS gains_percentage FROM ranked, (VALUES (10), (20), (30), (50)) x(pct) WHERE rank = n * pct // 100""",
       real="gains_percentage", whole="percent n_contacted cumulative_positives")
def gains_marks(t):
    return B.gains_marks(scored(t), "customer_id")


@query("decile_profit", WITH + DECILE_PROFIT + "SELECT * FROM decile_profit",
       real="threshold lift capture_rate expected_profit roi_percentage cost_per_retained", whole="customers_contacted")
def decile_profit(t):
    return B.decile_profit(scored(t), "customer_id")


@query("decile_summary", WITH + DECILE_PROFIT + """SELECT max(lift) AS best_decile_lift, min(lift) AS worst_decile_lift,
  sum(capture_rate) FILTER (decile <= 3) AS top_3_deciles_capture, sum(capture_rate) FILTER (decile <= 5) AS top_5_deciles_capture,
  sum(capture_rate) FILTER (decile <= 2) AS concentration_ratio,
  (SELECT decile FROM decile_profit ORDER BY expected_profit DESC, decile LIMIT 1) AS optimal_profit_decile,
  (SELECT decile FROM decile_profit ORDER BY roi_percentage DESC, decile LIMIT 1) AS optimal_roi_decile,
  max(expected_profit) AS max_expected_profit, max(roi_percentage) AS max_roi_percentage FROM decile_profit""",
       real="best_decile_lift worst_decile_lift top_3_deciles_capture top_5_deciles_capture concentration_ratio "
            "max_expected_profit max_roi_percentage", whole="optimal_profit_decile optimal_roi_decile")
def decile_summary(t):
    return B.decile_summary(scored(t), "customer_id")


@query("capture_rates", WITH + RANKED + """,
hit AS (SELECT pct, rank, cum_pos, n, p, score AS cut FROM ranked, (VALUES (5e0), (10e0), (15e0), (20e0), (25e0), (30e0), (40e0), (50e0)) x(pct)
        WHERE rank = floor(n * pct / 100)),
paired AS (SELECT pct, rank, cum_pos, p, cut, sum(label) AS tp, count(*) AS k FROM hit JOIN scored ON score >= cut GROUP BY ALL)
SELECT pct AS contact_percentage, rank AS customers_contacted, cum_pos AS churners_captured, cum_pos / p AS capture_rate,
  cut AS threshold, tp*1000e0 - k*50e0 - (p - tp)*500e0 AS expected_profit,
  (tp*1000e0 - k*50e0 + tp*500e0) * 100 / (k*50e0) AS roi_percentage, k*50e0 AS contact_cost, tp*1000e0 AS retention_revenue
FROM paired""", real="contact_percentage capture_rate threshold expected_profit roi_percentage contact_cost retention_revenue",
       whole="customers_contacted churners_captured")
def capture_rates(t):
    return B.capture_rates(scored(t), "customer_id")


METRICS_SQL = """,
runs AS (
  SELECT {by} score, count(*) AS k, sum(label) AS pos FROM {src} GROUP BY {by} score
),
cum AS (
  SELECT *, sum(k) OVER w AS cum_n, sum(pos) OVER w AS cum_pos FROM runs
  WINDOW w AS ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
),
curves AS (
  SELECT {by} sum((k - pos) * ((cum_pos - pos) + pos / 2e0)) / nullif(sum(pos)::DOUBLE * sum(k - pos), 0) AS roc_auc,
         CASE WHEN sum(k - pos) > 0 THEN sum(pos * cum_pos / cum_n) / nullif(sum(pos), 0) END AS pr_auc
  FROM cum {group}
),
flat AS (
  SELECT {by} count(*) AS n_samples, sum(label) AS n_positives, avg(label) AS base_rate,
         avg((score - label) * (score - label)) AS brier_score,
         avg(-CASE WHEN label = 1 THEN ln(least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
              ELSE ln(1 - least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) END) AS log_loss,
         avg(score) AS mean_score, stddev_pop(score) AS std_score,
         sum(CASE WHEN label = 1 AND score >= 5e-1 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN label = 0 AND score >= 5e-1 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN label = 0 AND score < 5e-1 THEN 1 ELSE 0 END) AS tn,
         sum(CASE WHEN label = 1 AND score < 5e-1 THEN 1 ELSE 0 END) AS fn
  FROM {src} {group}
),
metrics AS (
  SELECT flat.*, roc_auc, pr_auc, (tp + tn) / n_samples AS accuracy,
         coalesce(tp / nullif(tp+fp, 0), 0) AS "precision", coalesce(tp / nullif(tp+fn, 0), 0) AS recall,
         coalesce(2e0 * tp / nullif(2*tp+fp+fn, 0), 0) AS f1
  FROM flat {join} curves {using}
)
"""
METRICS1 = METRICS_SQL.format(by="", src="scored", part="", group="", join="CROSS JOIN", using="")
METRICS2 = METRICS_SQL.format(by="model,", src="models", part="PARTITION BY model", group="GROUP BY model", join="JOIN",
                              using="USING (model)")


@query("metric_set", WITH + METRICS1 + """SELECT n_samples, base_rate, roc_auc, pr_auc, brier_score, log_loss, accuracy,
  "precision", recall, f1 FROM metrics""",
       real="base_rate roc_auc pr_auc brier_score log_loss accuracy precision recall f1", whole="n_samples")
def overall_metrics(t):
    return metric_set(scored(t)).select("n_samples", "base_rate", "roc_auc", "pr_auc", "brier_score", "log_loss",
                                        "accuracy", "precision", "recall", "f1")


@query("model_metric_table", WITH2 + METRICS2 + """SELECT model, roc_auc, pr_auc, brier_score, log_loss, accuracy,
  "precision", recall, f1 FROM metrics""", real="roc_auc pr_auc brier_score log_loss accuracy precision recall f1")
def model_metric_table(t):
    return B.model_comparison(two_models(t))


@query("business_impact", WITH2 + CONF2 + f"SELECT model, {SAVINGS_FIELDS} FROM conf",
       real=SAVINGS_REAL, whole=SAVINGS_WHOLE)
def business_impact(t):
    return B.business_impact(two_models(t))


CURVE_SQL = METRICS2 + """,
tot AS (SELECT model, sum(label) AS np, count(*) - sum(label) AS nn FROM models GROUP BY model)
"""


@query("roc_curve", WITH2 + CURVE_SQL + """SELECT model, score AS threshold, (cum_n - cum_pos) / nn AS fpr, cum_pos / np AS tpr
  FROM cum JOIN tot USING (model)""", real="threshold fpr tpr")
def roc_curve(t):
    return B.roc_curve(two_models(t), ["model"])


@query("pr_curve", WITH2 + CURVE_SQL + """SELECT model, score AS threshold, cum_pos / cum_n AS "precision", cum_pos / np AS recall,
  np / (np + nn) AS baseline FROM cum JOIN tot USING (model)""", real="threshold precision recall baseline")
def pr_curve(t):
    return B.pr_curve(two_models(t), ["model"])


@query("executive_summary", WITH2 + METRICS2 + CONF2 + f""",
money AS (SELECT model, {SAVINGS_FIELDS} FROM conf),
best AS (SELECT model, roc_auc, total_profit, roi_percentage, contact_rate FROM metrics JOIN money USING (model)
         ORDER BY roc_auc DESC LIMIT 1)
SELECT best.model AS best_model, best.roc_auc AS best_roc_auc, best.total_profit AS best_model_profit,
  best.roi_percentage AS best_model_roi, best.contact_rate AS best_model_contact_rate,
  (SELECT min(total_profit) FROM money) AS min_profit, (SELECT max(total_profit) FROM money) AS max_profit,
  (SELECT max(roi_percentage) FROM money) AS max_roi, (SELECT count(*) FROM money) AS n_models FROM best""",
       real="best_roc_auc best_model_profit best_model_roi best_model_contact_rate min_profit max_profit max_roi",
       whole="n_models")
def executive_summary(t):
    return B.executive_summary(two_models(t))


BINS_SQL = """,
bins AS (
  SELECT {by} CAST((CASE WHEN score > 1e-1 THEN 1 ELSE 0 END) + (CASE WHEN score > 2e-1 THEN 1 ELSE 0 END)
      + (CASE WHEN score > 3e-1 THEN 1 ELSE 0 END) + (CASE WHEN score > 4e-1 THEN 1 ELSE 0 END)
      + (CASE WHEN score > 5e-1 THEN 1 ELSE 0 END) + (CASE WHEN score > 6e-1 THEN 1 ELSE 0 END)
      + (CASE WHEN score > 7e-1 THEN 1 ELSE 0 END) + (CASE WHEN score > 8e-1 THEN 1 ELSE 0 END)
      + (CASE WHEN score > 9e-1 THEN 1 ELSE 0 END) AS INTEGER) AS bin,
    count(*) AS n, avg(label) AS fraction_positive, avg(score) AS mean_predicted
  FROM {src} GROUP BY {by} bin
)
"""


@query("calibration_curve", WITH2 + BINS_SQL.format(by="model,", src="models") + "SELECT * FROM bins",
       real="fraction_positive mean_predicted", whole="n", digits=9)
def calibration_curve(t):
    return calibration_bins(two_models(t), ["model"])


@query("calibration_error", WITH2 + BINS_SQL.format(by="model,", src="models") + """SELECT model,
  avg(abs(fraction_positive - mean_predicted)) AS ece, max(abs(fraction_positive - mean_predicted)) AS mce,
  count(*) AS n_bins FROM bins GROUP BY model""", real="ece mce", whole="n_bins")
def calibration_error(t):
    return calibration_errors(calibration_bins(two_models(t), ["model"]), ["model"])


@query("unpivot_metrics", WITH2 + METRICS2 + """SELECT model, metric, value FROM
  (UNPIVOT (SELECT model, roc_auc, pr_auc, accuracy, f1 FROM metrics) ON roc_auc, pr_auc, accuracy, f1 INTO NAME metric VALUE value)""",
       real="value")
def unpivot_metrics(t):
    wide = B.model_comparison(two_models(t)).select("model", *[F.col(c) for c in ("roc_auc", "pr_auc", "accuracy", "f1")])
    return wide.unpivot("model", ["roc_auc", "pr_auc", "accuracy", "f1"], "metric", "value")
