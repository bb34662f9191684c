"""Performance, calibration and bias by segment, all segments in one grouped pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.expr import ratio
from retenta.plans.scoretable import calibration_bins, calibration_errors, confusion_aggregates, metric_set
from retenta.session import release, settle

LOGIT_EPS = 1e-15


def unpivot_segments(df: DataFrame, segment_cols: Sequence[str], keep: Sequence[str] = ("label", "score")) -> DataFrame:
    """Several segment columns as (segment_name, segment) rows; NULL segments dropped."""
    cells = F.array(*[F.struct(F.lit(c).alias("segment_name"), F.col(c).cast("string").alias("segment"))
                      for c in segment_cols])
    return df.select(*keep, F.explode(cells).alias("s")).select(*keep, "s.*").where("segment is not null")


BY = ["segment_name", "segment"]


def subgroup_performance(df: DataFrame, segment_cols: Sequence[str]) -> DataFrame:
    """Metric set per segment.  Segments with one class are kept and flagged, AUC/AP NULL."""
    m = metric_set(unpivot_segments(df, segment_cols), BY)
    return m.select(
        *BY, "n_samples", "n_positives", "base_rate", "roc_auc", "pr_auc", "brier_score", "log_loss",
        F.col("mean_score").alias("mean_predicted_prob"), F.col("std_score").alias("std_predicted_prob"),
        ((F.col("n_positives") == 0) | (F.col("n_positives") == F.col("n_samples"))).alias("single_class"),
    )


def calibration_slopes(df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score",
                       max_steps: int = 100, tolerance: float = 1e-9) -> DataFrame:
    """Slope and intercept of label ~ logit(score) per group, L2 penalty 1/2 on the slope.

    Newton steps: each one is a single grouped aggregate for all groups over
    the distinct (group, score) counts; only two numbers per group travel.
    `converged` is false for a group whose last step was still above the tolerance.
    """
    by = list(by)
    p = F.least(F.greatest(F.col(score), F.lit(LOGIT_EPS)), F.lit(1 - LOGIT_EPS))
    runs = df.groupBy(*by, F.ln(p / (1 - p)).alias("x")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    runs = settle(runs, "calibration-runs")
    state = runs.groupBy(*by).agg(F.sum("pos").alias("p"), F.sum("n").alias("m")).where("p > 0 and p < m")
    state = state.select(*by, F.lit(0.0).alias("w"), F.lit(0.0).alias("b"), F.lit(1.0).alias("change"))
    state = last = settle(state, "calibration-state")
    for _ in range(max_steps):
        z = F.col("w") * F.col("x") + F.col("b")
        mu = 1 / (1 + F.exp(-z))
        r, v = F.col("n") * mu - F.col("pos"), F.col("n") * mu * (1 - mu)
        x = F.col("x")
        sums = runs.join(state, by).groupBy(*by, "w", "b").agg(
            (F.sum(r * x) + F.col("w")).alias("gw"), F.sum(r).alias("gb"),
            (F.sum(v * x * x) + 1).alias("hww"), F.sum(v * x).alias("hwb"), F.sum(v).alias("hbb"))
        det = F.col("hww") * F.col("hbb") - F.col("hwb") * F.col("hwb")
        dw = (F.col("hbb") * F.col("gw") - F.col("hwb") * F.col("gb")) / det
        db = (F.col("hww") * F.col("gb") - F.col("hwb") * F.col("gw")) / det
        state = sums.select(*by, (F.col("w") - dw).alias("w"), (F.col("b") - db).alias("b"),
                            F.greatest(F.abs(dw), F.abs(db)).alias("change"))
        state, before = settle(state, "calibration-state"), last
        last = state
        release(before)
        largest = state.agg(F.max("change")).first()[0]
        if largest is None or largest < tolerance:
            break
    return state.select(*by, F.col("w").alias("calibration_slope"), F.col("b").alias("calibration_intercept"),
                        (F.col("change") < tolerance).alias("converged"))


def calibration_fairness(df: DataFrame, segment_cols: Sequence[str], with_slopes: bool = True) -> DataFrame:
    """ECE, MCE and (optionally) slope per segment that has both classes."""
    long = unpivot_segments(df, segment_cols)
    sizes = long.groupBy(*BY).agg(F.count(F.lit(1)).alias("n_samples"), F.avg(F.col("label").cast("double")).alias("base_rate"))
    out = calibration_errors(calibration_bins(long, BY), BY).join(sizes.where("base_rate > 0 and base_rate < 1"), BY)
    if with_slopes:
        out = out.join(calibration_slopes(long, BY), BY, "left")
    return out


def bias_metrics(df: DataFrame, segment_cols: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Prediction rate, TPR, FPR, PPV and parity difference per segment; NULL on empty divisors."""
    long = unpivot_segments(df, segment_cols)
    c = long.groupBy(*BY).agg(*confusion_aggregates(F.col("score") >= F.lit(threshold)))
    tp, fp, tn, fn = (F.col(k) for k in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    return c.select(
        *BY, n.alias("n_samples"), ratio(tp + fn, n).alias("base_rate"),
        ratio(tp + fp, n).alias("positive_prediction_rate"), ratio(tp, tp + fn).alias("true_positive_rate"),
        ratio(fp, fp + tn).alias("false_positive_rate"), ratio(tp, tp + fp).alias("positive_predictive_value"),
        (ratio(tp + fp, n) - ratio(tp + fn, n)).alias("statistical_parity_difference"))


def _violations(ranges: DataFrame, kinds: dict[str, str], limit: float) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(k).alias("violation"), F.col(c).alias("value")) for k, c in kinds.items()])
    return ranges.select("segment_name", F.explode(cells).alias("v")).select("segment_name", "v.*").where(
        F.col("value") > F.lit(limit)).withColumn("threshold", F.lit(limit))


def bias_violations(df: DataFrame, segment_cols: Sequence[str], threshold: float = 0.5, limit: float = 0.1) -> DataFrame:
    """Parity, opportunity and odds ranges over segments that exceed the limit."""
    m = bias_metrics(df, segment_cols, threshold)

    def spread(c: str) -> Column:
        return F.when(F.count(c) > 1, F.max(c) - F.min(c))

    ranges = m.groupBy("segment_name").agg(
        spread("positive_prediction_rate").alias("a"), spread("true_positive_rate").alias("b"),
        spread("false_positive_rate").alias("c"))
    return _violations(ranges, {"demographic_parity": "a", "equal_opportunity": "b", "equalized_odds_fpr": "c"}, limit)


def calibration_violations(df: DataFrame, segment_cols: Sequence[str], limit: float = 0.1, with_slopes: bool = True) -> DataFrame:
    """ECE gap and (sample) deviation of slopes over segments that exceed the limit."""
    m = calibration_fairness(df, segment_cols, with_slopes)
    aggs = [F.when(F.count("ece") > 1, F.max("ece") - F.min("ece")).alias("a")]
    kinds = {"ECE_gap": "a"}
    if with_slopes:
        aggs.append(F.stddev_samp("calibration_slope").alias("b"))
        kinds["calibration_slope_variance"] = "b"
    return _violations(m.groupBy("segment_name").agg(*aggs), kinds, limit)


def fairness_report(df: DataFrame, segment_cols: Sequence[str], threshold: float = 0.5, limit: float = 0.1,
                    with_slopes: bool = True) -> DataFrame:
    """One row per segment column with violation counts and advice, plus `overall_fair` and `total_violations`."""
    names = df.sparkSession.createDataFrame([(c,) for c in segment_cols], "segment_name string")
    bias = bias_violations(df, segment_cols, threshold, limit).groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("n_bias"), F.array_join(F.array_sort(F.collect_list("violation")), ", ").alias("kinds"))
    cal = calibration_violations(df, segment_cols, limit, with_slopes).groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("n_cal"))
    perf = subgroup_performance(df, segment_cols).groupBy("segment_name").agg(
        (F.max("roc_auc") - F.min("roc_auc")).alias("auc_range"), F.count(F.lit(1)).alias("n_segments"),
        F.min_by("segment", F.when(F.col("roc_auc").isNotNull(), F.struct("roc_auc", "segment"))).alias("worst_segment"))
    t = names.join(bias, "segment_name", "left").join(cal, "segment_name", "left").join(perf, "segment_name", "left")
    t = t.withColumns({"n_bias": F.coalesce("n_bias", F.lit(0)), "n_cal": F.coalesce("n_cal", F.lit(0))})
    total = t.agg(F.sum(F.col("n_bias") + F.col("n_cal"))).scalar()
    return t.select(
        "segment_name", (F.col("n_cal") == 0).alias("is_calibration_fair"), (F.col("n_bias") == 0).alias("is_bias_free"),
        F.col("n_cal").alias("n_calibration_violations"), F.col("n_bias").alias("n_bias_violations"),
        total.alias("total_violations"), (total == 0).alias("overall_fair"),
        F.array_join(fairness_advice(), " | ").alias("recommendations"))


def fairness_advice() -> Column:
    """Advice texts from the report's counts, the violation kinds and the AUC range."""
    name = F.col("segment_name")
    return F.array_compact(F.array(
        F.when(F.col("n_cal") > 0, F.concat(
            F.lit("Consider recalibrating the model for "), name, F.lit(" segments due to "),
            F.col("n_cal").cast("string"), F.lit(" calibration violations"))),
        F.when(F.col("n_bias") > 0, F.concat(
            F.lit("Address bias in "), name, F.lit(" segments. Detected violations: "), F.col("kinds"))),
        F.when((F.col("n_segments") > 1) & (F.col("auc_range") > 0.1), F.concat(
            F.lit("Consider collecting more data or feature engineering for "), name, F.lit(" segment '"),
            F.col("worst_segment"), F.lit("' which shows lower performance"))),
    ))
