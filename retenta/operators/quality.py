"""Quality report, outliers, imputation and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from retenta.functions.expr import clip, ratio, sample_kurtosis, sample_skewness
from retenta.params import OutlierParams
from retenta.plans.order import BIN, TIE_BIN, assign_bins
from retenta.plans.quantiles import fit_quantiles

NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in NUMERIC]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]


def iqr_bounds(df: DataFrame, cols: Sequence[str], factor: float = 1.5) -> dict[str, tuple[float, float]]:
    """Fences per column: quartiles -+ factor * IQR."""
    q = fit_quantiles(df, cols, [0.25, 0.75])
    return {c: (lo - factor * (hi - lo), hi + factor * (hi - lo)) for c, (lo, hi) in q.items() if lo is not None}


def outside(bounds: dict[str, tuple[float, float]], c: str) -> Column:
    low, high = bounds[c]
    return F.coalesce((F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high)), F.lit(False))


def any_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def iqr_outliers(df: DataFrame, cols: Sequence[str], params: OutlierParams = OutlierParams()) -> DataFrame:
    """Add `is_outlier`: outside the fences of any column."""
    bounds = iqr_bounds(df, cols, params.iqr_factor)
    return df.withColumn("is_outlier", any_of([outside(bounds, c) for c in bounds]))


def zscore_outliers(df: DataFrame, cols: Sequence[str], params: OutlierParams = OutlierParams()) -> DataFrame:
    """Add `is_outlier`: more than z_limit sample deviations from the mean in any column."""
    stats = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"{c}_m"), F.stddev_samp(c).alias(f"{c}_s"))]).first()
    flags = [F.coalesce(F.abs((F.col(c) - F.lit(stats[f"{c}_m"])) / F.lit(stats[f"{c}_s"])) > params.z_limit, F.lit(False))
             for c in cols if stats[f"{c}_s"]]
    return df.withColumn("is_outlier", any_of(flags))


def fit_winsor(df: DataFrame, cols: Sequence[str], params: OutlierParams = OutlierParams()) -> dict[str, tuple[float, float]]:
    q = fit_quantiles(df, cols, [params.winsor_low, params.winsor_high])
    return {c: (lo, hi) for c, (lo, hi) in q.items() if lo is not None}


def apply_winsor(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Clip to fitted bounds, so later data can reuse the training bounds."""
    return df.withColumns({c: clip(F.col(c), F.lit(lo), F.lit(hi)) for c, (lo, hi) in bounds.items()})


def winsorise(df: DataFrame, cols: Sequence[str], params: OutlierParams = OutlierParams()) -> DataFrame:
    return apply_winsor(df, fit_winsor(df, cols, params))


def _records(df: DataFrame, rows: dict[str, dict[str, Column]], key: str = "column") -> DataFrame:
    """One-row aggregate -> one row per key."""
    cells = F.array(*[F.struct(F.lit(k).alias(key), *[c.alias(n) for n, c in v.items()]) for k, v in rows.items()])
    return df.select(F.explode(cells).alias("r")).select("r.*")


def quality_report(df: DataFrame, params: OutlierParams = OutlierParams()) -> DataFrame:
    """Per column: type, missing values, IQR outliers (numeric columns only)."""
    nums = numeric_columns(df)
    bounds = iqr_bounds(df, nums, params.iqr_factor)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"m{i}"))
        out = F.count_if(outside(bounds, c)) if c in bounds else F.lit(None).cast("long")
        aggs.append(F.max(out) if c not in bounds else out)
        aggs[-1] = aggs[-1].alias(f"o{i}")
    types = dict(df.dtypes)
    one = df.agg(*aggs)
    return _records(one, {
        c: {"data_type": F.lit(types[c]), "n_rows": F.col("n"), "missing_count": F.col(f"m{i}"),
            "missing_percentage": F.col(f"m{i}") * 100.0 / F.col("n"), "outlier_count": F.col(f"o{i}")}
        for i, c in enumerate(df.columns)})


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows, columns and rows beyond the first copy."""
    per = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("k"))
    return per.agg(F.sum("k").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
                   F.sum(F.col("k") - 1).alias("duplicate_rows"))


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, most first, with their distinct counts."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"m{i}"), F.count_distinct(c).alias(f"d{i}")]
    types = dict(df.dtypes)
    rows = {c: {"data_type": F.lit(types[c]), "missing_count": F.col(f"m{i}"),
                "missing_percentage": F.col(f"m{i}") * 100.0 / F.col("n"), "unique_count": F.col(f"d{i}")}
            for i, c in enumerate(df.columns)}
    return _records(df.agg(*aggs), rows).where("missing_count > 0").orderBy(F.col("missing_count").desc(), "column")


def overall_summary(df: DataFrame, label: str) -> DataFrame:
    """Rows, label rate and missing share over all cells."""
    missing = sum((F.count_if(F.col(c).isNull()) for c in df.columns[1:]), F.count_if(F.col(df.columns[0]).isNull()))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_rows"), F.avg(F.col(label).cast("double")).alias("label_rate"),
                  (missing * 100.0 / (n * len(df.columns))).alias("missing_percentage"))


def impute(df: DataFrame, strategy: dict[str, str], order: Sequence[str] = ()) -> DataFrame:
    """mean | median | mode | forward_fill | drop per column, applied in dict order.

    A `drop` changes the rows later statistics see, so those are taken from the
    already filtered rows.  forward_fill needs `order`: (key, tie) columns.
    """
    for c, method in strategy.items():
        if method == "mean":
            df = df.withColumn(c, F.coalesce(F.col(c), df.agg(F.avg(c)).scalar()))
        elif method == "median":
            value = fit_quantiles(df, [c], [0.5])[c][0]
            df = df.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(value)))
        elif method == "mode":
            df = df.withColumn(c, F.coalesce(F.col(c), mode_value(df, c)))
        elif method == "forward_fill":
            df = forward_fill(df, c, *order)
        elif method == "drop":
            df = df.where(F.col(c).isNotNull())
        else:
            raise ValueError(f"unknown imputation method: {method}")
    return df


def mode_value(df: DataFrame, c: str) -> Column:
    """Most frequent value, smallest on ties, as a scalar."""
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("k"))
    best = counts.agg(F.max("k")).scalar()
    return counts.where(F.col("k") == best).agg(F.min(c)).scalar()


def forward_fill(df: DataFrame, c: str, key: str, tie: str) -> DataFrame:
    """Last earlier non-NULL value along (key, tie), across bins of the global order."""
    binned = assign_bins(df, key, tie)
    slot = [BIN, TIE_BIN]
    known = F.when(F.col(c).isNotNull(), F.struct(F.col(key), F.col(tie)))
    last = binned.groupBy(*slot).agg(F.max_by(F.col(c), known).alias("_last"))
    before = W.orderBy(*slot).rowsBetween(W.unboundedPreceding, -1)  # one row per bin
    carry = F.broadcast(last.select(*slot, F.last("_last", ignorenulls=True).over(before).alias("_carry")))
    inside = W.partitionBy(*slot).orderBy(key, tie).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col("_carry"))
    return binned.join(carry, slot).withColumn(c, filled).drop(*slot, "_carry")


def profile_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing, distinct, moments (bias-corrected skew and kurtosis) and quartiles per column."""
    q = fit_quantiles(df, cols, [0.25, 0.5, 0.75])
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.count_distinct(c).alias(f"d{i}"), F.avg(x).alias(f"a{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.skewness(x).alias(f"g{i}"), F.kurtosis(x).alias(f"k{i}")]
    rows = {}
    for i, c in enumerate(cols):
        n = F.col(f"n{i}")
        low, mid, high = (F.lit(v).cast("double") for v in q[c])
        rows[c] = {
            "missing_count": F.col("rows") - n, "missing_percentage": (F.col("rows") - n) * 100.0 / F.col("rows"),
            "unique_count": F.col(f"d{i}"), "mean": F.col(f"a{i}"), "median": mid, "std": F.col(f"s{i}"),
            "min": F.col(f"lo{i}"), "max": F.col(f"hi{i}"), "q25": low, "q75": high,
            "skewness": sample_skewness(n, F.col(f"g{i}")), "kurtosis": sample_kurtosis(n, F.col(f"k{i}")),
        }
    return _records(df.agg(*aggs), rows)


def value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value, n) over several columns in one pass; NULLs dropped."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(*by, F.explode(cells).alias("r")).select(*by, "r.*").where("value is not null")
    return long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_categorical(df: DataFrame, cols: Sequence[str], top: int = 10) -> DataFrame:
    """Top values per column with their share of the non-NULL rows; rank 1 is the mode."""
    counts = value_counts(df, cols)
    totals = counts.groupBy("column").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("unique_count"))
    order = W.partitionBy("column").orderBy(F.col("n").desc(), "value")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "column").select(
        "column", "rank", "value", F.col("n").alias("frequency"),
        (F.col("n") * 100.0 / F.col("rows")).alias("percentage"), "unique_count")


def describe_by(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per group and column (long form)."""
    from retenta.plans.quantiles import quantiles

    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    cells = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"a{i}").alias("mean"),
        F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)])
    flat = df.groupBy(group).agg(*aggs).select(group, F.explode(cells).alias("r")).select(group, "r.*")
    q = quantiles(df, cols, [0.25, 0.5, 0.75], [group])
    wide = q.groupBy(group, "column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))])
    return flat.join(wide, [group, "column"], "left")


def histogram(df: DataFrame, value: str, group: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over each group's own range, with density; the top edge is closed."""
    x = F.col(value).cast("double")
    narrow = df.select(group, x.alias("x")).where("x is not null")
    span = narrow.groupBy(group).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("rows"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    cells = narrow.join(span, group).groupBy(group, place.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.max("lo").alias("lo"), F.max("hi").alias("hi"), F.max("rows").alias("rows"))
    return cells.select(
        group, "bin", (F.col("lo") + F.col("bin") * width).alias("left_edge"), "n",
        ratio(F.col("n"), F.col("rows") * width).alias("density"))
