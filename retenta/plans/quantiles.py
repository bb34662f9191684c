"""Exact linear-interpolated quantiles that scale.

`percentile` keeps every distinct value of a group in one task.  Here a first
pass takes approximate cut points, a second counts rows per bin, and only the
rows of the few bins that hold a wanted position are shuffled and ordered.
The result is exact whatever the cut points are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from retenta.plans.order import bin_count, cut_points, with_positions


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              bins: int | None = None) -> DataFrame:
    """Long form (by..., column, prob, value, n); NULLs skipped, pandas 'linear' rule."""
    by, cols = list(by), list(cols)
    n_bins = bins or bin_count(df)
    narrow = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    if by:
        narrow = narrow.dropna(subset=by)
    cuts = narrow.agg(F.struct(*[cut_points(F.col(c), n_bins).alias(f"k{i}") for i, c in enumerate(cols)]).alias("c"))
    searches = [(c, f"_cuts.k{i}", f"_bin{i}") for i, c in enumerate(cols)]
    binned = with_positions(narrow.withColumn("_cuts", cuts.scalar()), searches, n_bins - 1)
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).alias("value"),
            F.col(f"_bin{i}").alias("bin"),
        )
        for i, c in enumerate(cols)
    ])
    long = binned.select(*by, F.explode(cells).alias("cell")).select(*by, "cell.*").where("value is not null")

    group = [*by, "column"]
    counts = long.groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("in_bin"))
    upto = W.partitionBy(*group).orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*group)
    placed = counts.select(
        *group, "bin",
        (F.sum("in_bin").over(upto) - F.col("in_bin")).alias("first"),
        F.sum("in_bin").over(upto).alias("next"),
        F.sum("in_bin").over(whole).alias("n"),
    )
    wanted = placed.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    wanted = wanted.withColumn("pos", (F.col("n") - 1) * F.col("prob"))
    wanted = wanted.withColumn("at", F.explode(F.array(F.floor("pos"), F.ceil("pos"))))
    wanted = wanted.where("at >= first and at < next").select(
        *group, "bin", "prob", "pos", "n", (F.col("at") - F.col("first")).alias("local"), "at"
    ).distinct()

    # at most bins x columns rows whatever the data
    used_bins = F.broadcast(wanted.select("column", "bin").distinct())
    kept = long.join(used_bins, ["column", "bin"], "left_semi")
    runs = kept.groupBy(*group, "bin", "value").agg(F.count(F.lit(1)).alias("m"))
    inside = W.partitionBy(*group, "bin").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    spans = runs.withColumn("stop", F.sum("m").over(inside)).withColumn("start", F.col("stop") - F.col("m"))
    hits = spans.join(wanted, [*group, "bin"]).where("local >= start and local < stop")
    low = F.max(F.when(F.col("at") == F.floor("pos"), F.col("value")))
    high = F.max(F.when(F.col("at") == F.ceil("pos"), F.col("value")))
    out = hits.groupBy(*group, "prob", "pos", "n").agg(low.alias("low"), high.alias("high"))
    value = F.col("low") + (F.col("high") - F.col("low")) * (F.col("pos") - F.floor("pos"))
    return out.select(*group, "prob", value.alias("value"), "n")


def fit_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                  bins: int | None = None) -> dict[str, list[float | None]]:
    """Exact whole-table quantiles as fitted values: {column: [value per prob]}; None for a column without values.

    The driver receives one row per column and probability, whatever the data.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols:
        return {}
    exact = {(r["column"], r["prob"]): r["value"] for r in quantiles(df, cols, probs, bins=bins).collect()}
    return {c: [exact.get((c, p)) for p in probs] for c in cols}
