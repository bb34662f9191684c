"""Building blocks for every metric over a scored DataFrame (label, score, id).

Confusion counts, the score histogram and the distinct-score running totals
answer all threshold, curve and fairness questions without looping over
thresholds, segments or models: groups are grouping columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.expr import ratio, thresholds_reached
from retenta.plans.order import running_totals

SWEEP = tuple(round(0.01 * i, 2) for i in range(1, 100))
LOG_EPS = 2.220446049250313e-16


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-group rows; without groups both sides are single rows."""
    if by:
        return left.join(right, list(by), how)
    key = "_one"
    return left.withColumn(key, F.lit(1)).join(right.withColumn(key, F.lit(1)), key, how).drop(key)


def confusion_aggregates(predicted: Column, label: str = "label", weight: Column | None = None) -> list[Column]:
    w = F.lit(1).cast("long") if weight is None else weight
    y = F.col(label) == 1
    zero = F.lit(0).cast("long")

    def count(cond: Column, name: str) -> Column:
        return F.sum(F.when(cond, w).otherwise(zero)).alias(name)

    return [count(y & predicted, "tp"), count(~y & predicted, "fp"),
            count(~y & ~predicted, "tn"), count(y & ~predicted, "fn")]


def confusion(df: DataFrame, threshold: float, by: Sequence[str] = (), label: str = "label",
              score: str = "score") -> DataFrame:
    """tp, fp, tn, fn per group at one threshold: a single aggregate."""
    return df.groupBy(*by).agg(*confusion_aggregates(F.col(score) >= F.lit(threshold), label))


def threshold_confusion(df: DataFrame, thresholds: Sequence[float] = SWEEP, by: Sequence[str] = (),
                        label: str = "label", score: str = "score") -> DataFrame:
    """One row per (group, threshold) from one pass over the rows.

    The rows collapse to a histogram of len(thresholds) + 1 cells per group;
    only that histogram is expanded against the thresholds.
    """
    ts = sorted(float(x) for x in thresholds)
    cells = df.select(*by, thresholds_reached(ts, F.col(score)).alias("reached"), F.col(label).alias("label"))
    cells = cells.groupBy(*by, "reached", "label").agg(F.count(F.lit(1)).alias("n"))
    marks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(x).alias("threshold")) for i, x in enumerate(ts)])
    wide = cells.withColumn("mark", F.explode(marks))
    predicted = F.col("reached") > F.col("mark.i")
    return wide.groupBy(*by, F.col("mark.threshold").alias("threshold")).agg(
        *confusion_aggregates(predicted, "label", F.col("n")))


def score_runs(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score: n, pos, and running n and pos from the highest score down."""
    runs = df.groupBy(*by, score).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    return running_totals(runs, score, {"cum_n": F.col("n"), "cum_pos": F.col("pos")}, by=by, descending=True)


def rates(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision, recall = ratio(tp, tp + fp, 0), ratio(tp, tp + fn, 0)
    return {
        "precision": precision,
        "recall": recall,
        "f1": F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0)),
    }


def metric_set(df: DataFrame, by: Sequence[str] = (), threshold: float = 0.5, label: str = "label",
               score: str = "score") -> DataFrame:
    """ROC-AUC (ties half), average precision (step sum), Brier, log loss and the
    thresholded rates, for every group at once.  AUC and AP are NULL for one class."""
    by = list(by)
    y, p = F.col(label).cast("double"), F.col(score)
    safe = F.least(F.greatest(p, F.lit(LOG_EPS)), F.lit(1 - LOG_EPS))
    flat = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum(F.col(label).cast("long")).alias("n_positives"),
        F.avg(y).alias("base_rate"),
        F.avg((p - y) * (p - y)).alias("brier_score"),
        F.avg(-(y * F.ln(safe) + (1 - y) * F.ln(1 - safe))).alias("log_loss"),
        F.avg(p).alias("mean_score"),
        F.stddev_pop(p).alias("std_score"),
        *confusion_aggregates(p >= F.lit(threshold), label),
    )
    runs = score_runs(df, by, label, score)
    neg = F.col("n") - F.col("pos")
    area = F.sum(neg * ((F.col("cum_pos") - F.col("pos")) + F.col("pos") / F.lit(2.0)))
    step = F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n"))
    ranked = runs.groupBy(*by).agg(
        ratio(area, F.sum("pos").cast("double") * F.sum(neg)).alias("roc_auc"),
        F.when(F.sum(neg) > 0, ratio(step, F.sum("pos"))).alias("pr_auc"),
    )
    out = join_groups(flat, ranked, by)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return out.withColumns({"accuracy": ratio(tp + tn, F.col("n_samples")), **rates(tp, fp, fn)})


def calibration_bins(df: DataFrame, by: Sequence[str] = (), bins: int = 10, label: str = "label",
                     score: str = "score") -> DataFrame:
    """Equal-width reliability bins (left-open, 0 in the first), empty ones absent."""
    edges = [i / bins for i in range(1, bins)]
    place = sum((F.when(F.col(score) > F.lit(e), 1).otherwise(0) for e in edges[1:]),
                F.when(F.col(score) > F.lit(edges[0]), 1).otherwise(0)) if edges else F.lit(0)
    return df.groupBy(*by, place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.avg(score).alias("mean_predicted"),
    )


def calibration_errors(bins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ECE as the plain mean of bin gaps (every bin weighs the same) and MCE as the largest."""
    gap = F.abs(F.col("fraction_positive") - F.col("mean_predicted"))
    return bins.groupBy(*by).agg(F.avg(gap).alias("ece"), F.max(gap).alias("mce"),
                                 F.count(F.lit(1)).alias("n_bins"))
