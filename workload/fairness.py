"""Segment performance and fairness of the customer score (by market segment and nation)."""

from retenta.operators import fairness as E
from workload.base import SCORED_SQL, scored
from workload.business import BINS_SQL, METRICS_SQL
from workload.registry import query

COLS = ["segment", "nation_key"]
LONG = "WITH RECURSIVE " + SCORED_SQL + """,
long AS (
  SELECT 'segment' AS segment_name, segment, label, score FROM scored
  UNION ALL SELECT 'nation_key', CAST(nation_key AS VARCHAR), label, score FROM scored
)
"""
PERF = LONG + METRICS_SQL.format(by="segment_name, segment,", src="long", part="PARTITION BY segment_name, segment",
                                 group="GROUP BY segment_name, segment", join="JOIN", using="USING (segment_name, segment)")
CAL = BINS_SQL.format(by="segment_name, segment,", src="long") + """,
both_classes AS (SELECT segment_name, segment, count(*) AS n_samples, avg(label) AS base_rate FROM long GROUP BY ALL
                 HAVING avg(label) > 0 AND avg(label) < 1),
cal AS (
  SELECT segment_name, segment, avg(abs(fraction_positive - mean_predicted)) AS ece,
         max(abs(fraction_positive - mean_predicted)) AS mce, count(*) AS n_bins,
         any_value(n_samples) AS n_samples, any_value(base_rate) AS base_rate
  FROM bins JOIN both_classes USING (segment_name, segment) GROUP BY segment_name, segment
)
"""
# Newton steps of label ~ logit(score), one row per group and step
SLOPES = """,
logits AS (SELECT segment_name, segment, ln(p / (1e0 - p)) AS x, count(*) AS n, sum(label) AS pos
           FROM (SELECT *, least(greatest(score, 1e-15), 1e0 - 1e-15) AS p FROM long) GROUP BY 1, 2, 3),
newton AS (
  SELECT segment_name, segment, 0 AS step, 0e0 AS w, 0e0 AS b FROM logits GROUP BY 1, 2 HAVING sum(pos) > 0 AND sum(pos) < sum(n)
  UNION ALL
  SELECT segment_name, segment, step + 1, w - (hbb * gw - hwb * gb) / (hww * hbb - hwb * hwb), b - (hww * gb - hwb * gw) / (hww * hbb - hwb * hwb)
  FROM (SELECT segment_name, segment, step, w, b, sum((n * mu - pos) * x) + w AS gw, sum(n * mu - pos) AS gb,
               sum(n * mu * (1e0 - mu) * x * x) + 1e0 AS hww, sum(n * mu * (1e0 - mu) * x) AS hwb, sum(n * mu * (1e0 - mu)) AS hbb
        FROM (SELECT s.*, x, n, pos, 1e0 / (1e0 + exp(-(w * x + b))) AS mu FROM newton s JOIN logits USING (segment_name, segment) WHERE step < 30)
        GROUP BY 1, 2, 3, 4, 5)
),
slopes AS (SELECT segment_name, segment, w AS calibration_slope, b AS calibration_intercept, TRUE AS converged FROM newton WHERE step = 30)
"""
BIAS = """,
conf AS (
  SELECT segment_name, segment, count(*) AS n,
         sum(CASE WHEN label = 1 AND score >= 5e-1 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN label = 0 AND score >= 5e-1 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN label = 0 AND score < 5e-1 THEN 1 ELSE 0 END) AS tn,
         sum(CASE WHEN label = 1 AND score < 5e-1 THEN 1 ELSE 0 END) AS fn
  FROM long GROUP BY ALL
),
bias AS (
  SELECT segment_name, segment, n AS n_samples, (tp+fn)/n AS base_rate, (tp+fp)/n AS positive_prediction_rate,
         tp/nullif(tp+fn,0) AS true_positive_rate, fp/nullif(fp+tn,0) AS false_positive_rate,
         tp/nullif(tp+fp,0) AS positive_predictive_value, (tp+fp)/n - (tp+fn)/n AS statistical_parity_difference
  FROM conf
),
bias_ranges AS (
  SELECT segment_name, 'demographic_parity' AS violation, max(positive_prediction_rate)-min(positive_prediction_rate) AS value FROM bias GROUP BY 1
  UNION ALL SELECT segment_name, 'equal_opportunity', max(true_positive_rate)-min(true_positive_rate) FROM bias GROUP BY 1
  UNION ALL SELECT segment_name, 'equalized_odds_fpr', max(false_positive_rate)-min(false_positive_rate) FROM bias GROUP BY 1
),
bias_bad AS (SELECT segment_name, violation, value, 1e-1 AS threshold FROM bias_ranges WHERE value > 1e-1)
"""
CAL_BAD = """,
cal_bad AS (SELECT segment_name, 'ECE_gap' AS violation, max(ece) - min(ece) AS value, 1e-1 AS threshold FROM cal
            GROUP BY segment_name HAVING max(ece) - min(ece) > 1e-1
            UNION ALL SELECT segment_name, 'calibration_slope_variance', stddev_samp(calibration_slope), 1e-1
            FROM cal JOIN slopes USING (segment_name, segment) GROUP BY segment_name HAVING stddev_samp(calibration_slope) > 1e-1)
"""


@query("subgroup_performance", PERF + """SELECT segment_name, segment, n_samples, n_positives, base_rate, roc_auc, pr_auc,
  brier_score, log_loss, mean_score AS mean_predicted_prob, std_score AS std_predicted_prob,
  (n_positives = 0 OR n_positives = n_samples) AS single_class FROM metrics""",
       real="base_rate roc_auc pr_auc brier_score log_loss mean_predicted_prob std_predicted_prob",
       whole="n_samples n_positives")
def subgroup_performance(t):
    return E.subgroup_performance(scored(t), COLS)


@query("calibration_slopes", LONG + SLOPES + "SELECT * FROM slopes", real="calibration_slope calibration_intercept")
def calibration_slopes(t):
    return E.calibration_slopes(E.unpivot_segments(scored(t), COLS), E.BY)


@query("calibration_by_segment", LONG + CAL + SLOPES + """SELECT segment_name, segment, ece, mce, n_bins, n_samples, base_rate,
  calibration_slope, calibration_intercept, converged FROM cal LEFT JOIN slopes USING (segment_name, segment)""",
       real="ece mce base_rate calibration_slope calibration_intercept", whole="n_bins n_samples")
def calibration_by_segment(t):
    return E.calibration_fairness(scored(t), COLS)


@query("calibration_violations", LONG + CAL + SLOPES + CAL_BAD + "SELECT * FROM cal_bad", real="value threshold")
def calibration_violations(t):
    return E.calibration_violations(scored(t), COLS)


@query("bias_metrics", LONG + BIAS + "SELECT * FROM bias",
       real="base_rate positive_prediction_rate true_positive_rate false_positive_rate positive_predictive_value "
            "statistical_parity_difference", whole="n_samples")
def bias_metrics(t):
    return E.bias_metrics(scored(t), COLS)


@query("bias_violations", LONG + BIAS + "SELECT * FROM bias_bad", real="value threshold")
def bias_violations(t):
    return E.bias_violations(scored(t), COLS)


@query("fairness_report", PERF + CAL + SLOPES + BIAS + CAL_BAD + """,
names AS (SELECT 'segment' AS segment_name UNION ALL SELECT 'nation_key'),
nb AS (SELECT segment_name, count(*) AS k, string_agg(violation, ', ' ORDER BY violation) AS kinds FROM bias_bad GROUP BY 1),
nc AS (SELECT segment_name, count(*) AS k FROM cal_bad GROUP BY 1),
pf AS (SELECT segment_name, max(roc_auc) - min(roc_auc) AS auc_range, count(*) AS n_segments,
         (SELECT segment FROM metrics i WHERE i.segment_name = o.segment_name AND roc_auc IS NOT NULL ORDER BY roc_auc, segment LIMIT 1) AS worst
       FROM metrics o GROUP BY 1),
rep AS (SELECT names.segment_name, coalesce(nc.k, 0) AS c, coalesce(nb.k, 0) AS b, kinds, auc_range, n_segments, worst
        FROM names LEFT JOIN nb USING (segment_name) LEFT JOIN nc USING (segment_name) LEFT JOIN pf USING (segment_name))
SELECT segment_name, c = 0 AS is_calibration_fair, b = 0 AS is_bias_free, c AS n_calibration_violations, b AS n_bias_violations,
  (SELECT sum(c + b) FROM rep) AS total_violations, (SELECT sum(c + b) FROM rep) = 0 AS overall_fair,
  concat_ws(' | ',
    CASE WHEN c > 0 THEN 'Consider recalibrating the model for ' || segment_name || ' segments due to ' || c || ' calibration violations' END,
    CASE WHEN b > 0 THEN 'Address bias in ' || segment_name || ' segments. Detected violations: ' || kinds END,
    CASE WHEN n_segments > 1 AND auc_range > 1e-1 THEN 'Consider collecting more data or feature engineering for ' || segment_name
      || ' segment ''' || worst || ''' which shows lower performance' END) AS recommendations
FROM rep""", whole="n_calibration_violations n_bias_violations total_violations")
def fairness_report(t):
    return E.fairness_report(scored(t), COLS)
