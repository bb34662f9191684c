"""Hypothesis tests, effect sizes and correlations, all columns in one grouped pass.

p-values are Arrow functions on the result rows (one row per test); the data
itself only meets aggregates and the distributed rank helper.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from retenta.functions.expr import ratio
from retenta.functions.pvalues import chi_square_p, correlation_p, fisher_p, mann_whitney_exact_p, normal_p
from retenta.operators.quality import numeric_columns, value_counts
from retenta.plans.order import average_ranks, running_totals
from retenta.plans.quantiles import quantiles

EXACT_GROUP = 8


def effect_band(v: Column) -> Column:
    a = F.abs(v)
    return F.when(a < 0.1, "negligible").when(a < 0.3, "small").when(a < 0.5, "medium").when(a >= 0.5, "large")


def unpivot_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep..., column, x) with NULLs of x and keep dropped."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])
    return df.select(*keep, F.explode(cells).alias("r")).select(*keep, "r.*").dropna()


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table (a, b, n); rows with a NULL dropped."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def rate_by_category(df: DataFrame, category: str, label: str) -> DataFrame:
    """Label rate and count per category, highest rate first."""
    return df.where(F.col(category).isNotNull()).groupBy(category).agg(
        F.avg(F.col(label).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n")
    ).orderBy(F.col("rate").desc(), category)


def _independence(cells: DataFrame, key: Sequence[str]) -> DataFrame:
    """chi2, dof, n, smallest expected count and Cramer's V from (key, a, b, n) cells.

    Without correction chi2 = n (sum O^2 / (R C) - 1), so absent cells need no
    row.  A 2 x 2 table gets the continuity correction: all four |O - E| agree
    there, and sum 1/E = n sum(1/R) sum(1/C).
    """
    key = list(key)
    rows = cells.groupBy(*key, "a").agg(F.sum("n").alias("r"))
    cols = cells.groupBy(*key, "b").agg(F.sum("n").alias("c"))
    r = rows.groupBy(*key).agg(F.sum("r").alias("total"), F.count(F.lit(1)).alias("n_rows"), F.min("r").alias("min_r"),
                               F.sum(1 / F.col("r")).alias("inv_r"))
    c = cols.groupBy(*key).agg(F.count(F.lit(1)).alias("n_cols"), F.min("c").alias("min_c"), F.sum(1 / F.col("c")).alias("inv_c"))
    one = cells.join(rows, [*key, "a"]).join(cols, [*key, "b"]).join(r, key).groupBy(*key).agg(
        F.sum(F.col("n").cast("double") * F.col("n") / (F.col("r").cast("double") * F.col("c"))).alias("s"),
        F.max(F.abs(F.col("n") - F.col("r").cast("double") * F.col("c") / F.col("total"))).alias("gap"))
    t = one.join(r, key).join(c, key)
    n = F.col("total").cast("double")
    dof = (F.col("n_rows") - 1) * (F.col("n_cols") - 1)
    yates = F.greatest(F.col("gap") - 0.5, F.lit(0.0))
    plain = n * (F.col("s") - 1)
    chi2 = F.when(dof == 1, yates * yates * n * F.col("inv_r") * F.col("inv_c")).when(dof == 0, F.lit(0.0)).otherwise(plain)
    t = t.withColumns({"chi2": F.greatest(chi2, F.lit(0.0)), "dof": dof})
    v = F.sqrt(ratio(F.col("chi2"), n * (F.least("n_rows", "n_cols") - 1)))
    return t.select(*key, F.col("total").alias("n"), "chi2", "dof",
                    (F.col("min_r").cast("double") * F.col("min_c") / n).alias("min_expected"), v.alias("cramers_v"))


def chi_square(df: DataFrame, cols: Sequence[str], label: str, alpha: float = 0.05) -> DataFrame:
    """Chi-square test of every categorical column against the label."""
    counts = value_counts(df.where(F.col(label).isNotNull()), cols, [label])
    cells = counts.select("column", F.col("value").alias("a"), F.col(label).alias("b"), "n")
    t = _independence(cells, ["column"])
    enough = F.col("n") >= 5
    p = chi_square_p(F.col("chi2"), F.greatest(F.col("dof"), F.lit(1)).cast("double"))
    t = t.withColumn("p_value", F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(p))
    return t.select(
        "column", F.lit("Chi-square").alias("test_name"), F.when(enough, F.col("chi2")).alias("statistic"),
        F.when(enough, F.col("p_value")).alias("p_value"), F.when(enough, F.col("dof")).alias("degrees_of_freedom"),
        F.when(enough, F.col("cramers_v")).alias("effect_size"), F.lit("Cramér's V").alias("effect_size_name"),
        F.when(enough, effect_band(F.col("cramers_v"))).alias("effect_interpretation"),
        F.when(~enough, "insufficient_data").when(F.col("min_expected") < 5, "assumption_violated")
        .otherwise("valid").alias("interpretation"),
        (enough & (F.col("p_value") < alpha)).alias("is_significant"), "min_expected")


def _label_ranks(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    long = unpivot_numeric(df, cols, [label])
    return average_ranks(long, "x", by=["column"], carry={"pos": F.sum((F.col(label) == 1).cast("long"))})


def mann_whitney(df: DataFrame, cols: Sequence[str], label: str, alpha: float = 0.05) -> DataFrame:
    """U of label 1 against 0 per numeric column, with the rank-biserial effect 1 - 2U/(n1 n0)."""
    runs = _label_ranks(df, cols, label)
    k, r = F.col("n").cast("double"), F.col("avg_rank")
    t = runs.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("n1"), F.sum(F.col("pos") * r).alias("rank_sum"),
        F.sum(k * k * k - k).alias("ties"))
    n1, n0 = F.col("n1").cast("double"), (F.col("n") - F.col("n1")).cast("double")
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    n = F.col("n").cast("double")
    sd = F.sqrt(n1 * n0 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    z = ratio(F.greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5, sd)
    t = t.withColumns({"u": u, "z": z})
    exact = (F.least(n1, n0) <= EXACT_GROUP) & (F.col("ties") == 0)
    normal = F.when(F.col("z") < 0, F.lit(1.0)).otherwise(normal_p(F.col("z")))
    few = F.col("n") < 10
    small = (n1 < 3) | (n0 < 3)
    valid = ~few & ~small
    tail = mann_whitney_exact_p(F.when(exact & valid, F.col("u")), F.col("n1"), F.col("n") - F.col("n1"))
    t = t.withColumn("p_value", F.coalesce(tail, normal))
    effect = 1 - 2 * F.col("u") / (n1 * n0)
    t = t.withColumn("effect", F.when(valid, effect))
    return t.select(
        "column", F.lit("Mann-Whitney U").alias("test_name"), F.when(valid, F.col("u")).alias("statistic"),
        F.when(valid, F.col("p_value")).alias("p_value"), F.col("effect").alias("effect_size"),
        F.lit("rank-biserial correlation").alias("effect_size_name"), effect_band(F.col("effect")).alias("effect_interpretation"),
        F.when(few, "insufficient_data").when(small, "insufficient_group_size").otherwise("valid").alias("interpretation"),
        (valid & (F.col("p_value") < alpha)).alias("is_significant"))


def group_statistics(df: DataFrame, cols: Sequence[str], group: str, population_std: bool = False) -> DataFrame:
    """n, mean, std, median and quartiles per group and column."""
    long = unpivot_numeric(df, cols, [group])
    std = F.stddev_pop("x") if population_std else F.stddev_samp("x")
    flat = long.groupBy(group, "column").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), std.alias("std"))
    q = quantiles(df.where(F.col(group).isNotNull()), cols, [0.25, 0.5, 0.75], [group])
    wide = q.groupBy(group, "column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(m) for m, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))])
    return flat.join(wide, [group, "column"])


def fisher_exact(df: DataFrame, cols: Sequence[str], label: str, alpha: float = 0.05, below: int | None = None) -> DataFrame:
    """Odds ratio and p of 2 x 2 tables (with fewer than `below` rows); other tables are marked `not_binary`."""
    counts = value_counts(df.where(F.col(label).isNotNull()), cols, [label])
    low = counts.groupBy("column").agg(F.min("value").alias("v0"), F.min(label).alias("l0"),
                                       F.count_distinct("value").alias("nv"), F.count_distinct(label).alias("nl"))
    t = counts.join(low, "column")
    first_row, first_col = F.col("value") == F.col("v0"), F.col(label) == F.col("l0")

    def cell(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))

    t = t.groupBy("column", "nv", "nl").agg(
        cell(first_row & first_col).alias("a"), cell(first_row & ~first_col).alias("b"),
        cell(~first_row & first_col).alias("c"), cell(~first_row & ~first_col).alias("d"))
    valid = (F.col("nv") == 2) & (F.col("nl") == 2)
    if below is not None:
        # a filter, so the p-value is never worked out for tables the caller leaves to another test
        t = t.where(F.col("a") + F.col("b") + F.col("c") + F.col("d") < below)
    t = t.withColumn("p_value", fisher_p(F.when(valid, F.col("a")), F.col("b"), F.col("c"), F.col("d")))
    odds = ratio(F.col("a").cast("double") * F.col("d"), F.col("b").cast("double") * F.col("c"))
    return t.select("column", F.lit("Fisher's exact").alias("test_name"), F.when(valid, odds).alias("statistic"),
                    F.col("p_value"), F.when(valid, "valid").otherwise("not_binary").alias("interpretation"),
                    F.coalesce(F.col("p_value") < alpha, F.lit(False)).alias("is_significant"))


def kruskal_wallis(df: DataFrame, value: str, group: str, alpha: float = 0.05) -> DataFrame:
    """Tie-corrected H over groups with at least 3 rows."""
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("x")).dropna()
    cells = rows.groupBy("g", "x").agg(F.count(F.lit(1)).alias("m"))
    sizes = cells.groupBy("g").agg(F.sum("m").alias("size")).where("size >= 3")
    cells = cells.join(sizes, "g")
    runs = _weighted_ranks(cells, [], "x").withColumnRenamed("rank_x", "rank")
    runs = runs.join(cells.groupBy("x").agg(F.sum("m").alias("total")), "x")
    per_group = cells.join(runs.select("x", "rank"), "x").groupBy("g").agg(
        F.sum(F.col("m") * F.col("rank")).alias("r"), F.max("size").alias("size"))
    k = F.col("total").cast("double")
    ties = runs.agg(F.sum(k * k * k - k).alias("ties"), F.sum("total").alias("n"))
    total = per_group.agg(F.sum(F.col("r") * F.col("r") / F.col("size")).alias("s"), F.count(F.lit(1)).alias("groups"))
    t = total.withColumn("j", F.lit(1)).join(ties.withColumn("j", F.lit(1)), "j")
    n = F.col("n").cast("double")
    h = ratio(12 / (n * (n + 1)) * F.col("s") - 3 * (n + 1), 1 - F.col("ties") / (n * n * n - n))
    valid = F.col("groups") >= 2
    t = t.withColumns({"h": F.when(valid, h), "dof": F.col("groups") - 1})
    t = t.withColumn("p_value", chi_square_p(F.col("h"), F.col("dof").cast("double")))
    return t.select(F.lit(value).alias("column"), F.lit("Kruskal-Wallis").alias("test_name"), F.col("h").alias("statistic"),
                    "p_value", F.col("dof").alias("degrees_of_freedom"),
                    F.when(valid, "valid").otherwise("insufficient_groups").alias("interpretation"),
                    F.coalesce(F.col("p_value") < alpha, F.lit(False)).alias("is_significant"))


TEST_COLUMNS = ("column", "test_name", "statistic", "p_value", "effect_size", "effect_size_name",
                "effect_interpretation", "interpretation", "is_significant")


def test_all(df: DataFrame, label: str, cols: Sequence[str] | None = None, alpha: float = 0.05,
             correction: str | None = "bonferroni", fisher_below: int = 100) -> DataFrame:
    """Numeric columns: Mann-Whitney; binary against binary under 100 rows: Fisher; else chi-square."""
    cols = [c for c in (cols or df.columns) if c != label]
    nums = [c for c in numeric_columns(df) if c in cols]
    cats = [c for c in cols if c not in nums]
    parts = []
    if nums:
        parts.append(mann_whitney(df, nums, label, alpha).select(*TEST_COLUMNS))
    if cats:
        chi = chi_square(df, cats, label, alpha)
        sizes = value_counts(df.where(F.col(label).isNotNull()), cats, [label]).groupBy("column").agg(
            F.sum("n").alias("rows"), F.count_distinct("value").alias("nv"), F.count_distinct(label).alias("nl"))
        use = sizes.select("column", ((F.col("nv") == 2) & (F.col("nl") == 2) & (F.col("rows") < fisher_below)).alias("fisher"))
        none = F.lit(None)
        fish = fisher_exact(df, cats, label, alpha, fisher_below).select(
            "column", "test_name", "statistic", "p_value", none.cast("double").alias("effect_size"),
            F.lit("").alias("effect_size_name"), F.lit("").alias("effect_interpretation"), "interpretation", "is_significant")
        parts.append(chi.select(*TEST_COLUMNS).join(use.where("not fisher").select("column"), "column"))
        parts.append(fish.join(use.where("fisher").select("column"), "column"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return correct_p_values(out, correction, alpha) if correction else out


def correct_p_values(tests: DataFrame, method: str = "bonferroni", alpha: float = 0.05) -> DataFrame:
    """Bonferroni (capped at 1) or Holm step-down over the tests with a p-value (one row per test)."""
    m = F.count("p_value").over(W.partitionBy())
    if method == "bonferroni":
        corrected = F.least(F.col("p_value") * m, F.lit(1.0))
    elif method == "holm":
        order = W.orderBy(F.col("p_value").asc_nulls_last(), "column")
        step = F.least(F.col("p_value") * (m - F.row_number().over(order) + 1), F.lit(1.0))
        tests = tests.withColumn("_step", step)
        corrected = F.when(F.col("p_value").isNotNull(), F.max("_step").over(order.rowsBetween(W.unboundedPreceding, 0)))
    else:
        raise ValueError(f"unknown correction: {method}")
    out = tests.withColumn("p_value_corrected", corrected)
    out = out.withColumn("is_significant_corrected", F.col("p_value_corrected") < alpha)
    return out.withColumn("correction_method", F.lit(method)).drop("_step")


def effect_sizes(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Cohen's d (pooled), point-biserial and Spearman per numeric column; one pass over value runs."""
    runs = _label_ranks(df, cols, label)
    n, pos, x, r = F.col("n").cast("double"), F.col("pos").cast("double"), F.col("x"), F.col("avg_rank")
    s = runs.groupBy("column").agg(
        F.sum(n).alias("n"), F.sum(pos).alias("n1"), F.sum(n * x).alias("sx"), F.sum(pos * x).alias("sx1"),
        F.sum(n * r).alias("sr"), F.sum(n * r * r).alias("srr"), F.sum(pos * r).alias("sr1"))
    mean = s.select("column", (F.col("sx") / F.col("n")).alias("mx"),
                    ratio(F.col("sx1"), F.col("n1")).alias("m1"),
                    ratio(F.col("sx") - F.col("sx1"), F.col("n") - F.col("n1")).alias("m0"))
    spread = runs.join(mean, "column").groupBy("column").agg(
        F.sum(n * (x - F.col("mx")) * (x - F.col("mx"))).alias("vx"),
        F.sum(pos * (x - F.col("m1")) * (x - F.col("m1"))).alias("v1"),
        F.sum((n - pos) * (x - F.col("m0")) * (x - F.col("m0"))).alias("v0"))
    t = s.join(mean, "column").join(spread, "column")
    N, n1 = F.col("n"), F.col("n1")
    label_var = n1 * (N - n1) / N
    pooled = F.sqrt(ratio(F.col("v1") + F.col("v0"), N - 2))
    return t.where(N >= 10).select(
        "column", ratio(F.col("m1") - F.col("m0"), pooled).alias("cohens_d"),
        ratio(F.col("sx1") - n1 * F.col("mx"), F.sqrt(F.col("vx") * label_var)).alias("point_biserial_correlation"),
        ratio(F.col("sr1") - n1 * F.col("sr") / N,
              F.sqrt((F.col("srr") - F.col("sr") * F.col("sr") / N) * label_var)).alias("spearman_correlation"))


def testing_report(tests: DataFrame, effects: DataFrame | None = None) -> DataFrame:
    """Tests with effect sizes attached: significant first, then by p-value."""
    out = tests if effects is None else tests.join(effects, "column", "left")
    return out.orderBy(F.col("is_significant").desc(), F.col("p_value").asc_nulls_last(), "column")


def correlation_pairs(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    """(col1, col2, r, n) for i < j over pairwise complete rows."""
    pairs = list(combinations(cols, 2))
    if method == "pearson":
        aggs = []
        for i, (a, b) in enumerate(pairs):
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            aggs += [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}"), F.count_if(both).alias(f"n{i}")]
        cells = F.array(*[F.struct(F.lit(a).alias("col1"), F.lit(b).alias("col2"), F.col(f"r{i}").alias("r"),
                                   F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(pairs)])
        return df.agg(*aggs).select(F.explode(cells).alias("c")).select("c.*")
    cells = F.array(*[F.struct(F.lit(a).alias("col1"), F.lit(b).alias("col2"), F.col(a).cast("double").alias("x"),
                               F.col(b).cast("double").alias("y")) for a, b in pairs])
    key = ["col1", "col2"]
    joint = df.select(F.explode(cells).alias("c")).select("c.*").dropna().groupBy(*key, "x", "y").agg(
        F.count(F.lit(1)).alias("m"))
    for side in ("x", "y"):
        joint = joint.join(_weighted_ranks(joint, key, side), [*key, side])
    m, rx, ry = F.col("m").cast("double"), F.col("rank_x"), F.col("rank_y")
    s = joint.groupBy(*key).agg(F.sum(m).alias("n"), F.sum(m * rx).alias("sx"), F.sum(m * ry).alias("sy"),
                                F.sum(m * rx * ry).alias("sxy"), F.sum(m * rx * rx).alias("sxx"), F.sum(m * ry * ry).alias("syy"))
    n = F.col("n")
    top = F.col("sxy") - F.col("sx") * F.col("sy") / n
    down = F.sqrt((F.col("sxx") - F.col("sx") * F.col("sx") / n) * (F.col("syy") - F.col("sy") * F.col("sy") / n))
    return s.select(*key, ratio(top, down).alias("r"), n.cast("long").alias("n"))


def _weighted_ranks(cells: DataFrame, key: Sequence[str], side: str) -> DataFrame:
    runs = cells.groupBy(*key, side).agg(F.sum("m").alias("k"))
    cum = running_totals(runs, side, {"cum": F.col("k")}, by=key)
    return cum.select(*key, side, (F.col("cum") - (F.col("k") - 1) / 2.0).alias(f"rank_{side}"))


def prepare_correlation(df: DataFrame, include_categorical: bool = True, max_categories: int = 10) -> DataFrame:
    """Two-value texts become sorted codes, up to ten values become dummies (first dropped), others go."""
    nums = numeric_columns(df)
    out = [F.col(c) for c in nums]
    if include_categorical:
        for c in [x for x in df.columns if x not in nums]:
            found = df.where(F.col(c).isNotNull()).select(c).distinct().limit(max_categories + 1).collect()
            values = sorted(r[0] for r in found)
            if len(values) == 2:
                out.append(F.when(F.col(c) == values[0], 0).when(F.col(c) == values[1], 1).otherwise(-1).alias(c))
            elif len(values) <= max_categories:
                out += [F.coalesce(F.col(c) == v, F.lit(False)).cast("int").alias(f"{c}_{v}") for v in values[1:]]
    return df.select(*out)


def cramers_v_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cramer's V for every pair of categorical columns (diagonal 1, undefined 0), long form."""
    pairs = list(combinations(cols, 2))
    cells = F.array(*[F.struct(F.lit(a).alias("col1"), F.lit(b).alias("col2"), F.col(a).cast("string").alias("a"),
                               F.col(b).cast("string").alias("b")) for a, b in pairs])
    counts = df.select(F.explode(cells).alias("c")).select("c.*").dropna().groupBy("col1", "col2", "a", "b").agg(
        F.count(F.lit(1)).alias("n"))
    half = _independence(counts, ["col1", "col2"]).select("col1", "col2", F.coalesce("cramers_v", F.lit(0.0)).alias("v"))
    flipped = half.select(F.col("col2").alias("col1"), F.col("col1").alias("col2"), "v")
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col1 string, col2 string, v double")
    return half.unionByName(flipped).unionByName(diagonal)


def significant_pairs(pairs: DataFrame, alpha: float = 0.05, min_rows: int = 10) -> DataFrame:
    """Pairs whose correlation has p < alpha, on more than ten rows."""
    return pairs.where((F.col("n") > min_rows) & F.col("r").isNotNull()).withColumn(
        "p_value", correlation_p(F.col("r"), F.col("n").cast("double"))).where(F.col("p_value") < alpha)


def high_pairs(pairs: DataFrame, limit: float = 0.7) -> DataFrame:
    return pairs.where(F.abs("r") > limit)


def analysis_summary(tests: DataFrame, pairs: DataFrame, alpha: float = 0.05, limit: float = 0.7) -> DataFrame:
    """Counts of tested and significant columns, their names, and high correlations."""
    name = F.when(F.col("p_value") < alpha, F.col("column"))
    t = tests.agg(F.count(F.lit(1)).alias("total_features"), F.count(name).alias("significant_features"),
                  F.array_join(F.array_sort(F.collect_list(name)), ",").alias("significant_feature_names"))
    p = pairs.agg(F.count_if(F.abs("r") > limit).alias("high_correlations_count"))
    return t.withColumn("j", F.lit(1)).join(p.withColumn("j", F.lit(1)), "j").drop("j")


def top_correlated(df: DataFrame, target: str, cols: Sequence[str], top: int = 10) -> DataFrame:
    """Columns by absolute Pearson correlation with the target."""
    y = F.col(target).cast("double")
    one = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(f"r{i}") for i, c in enumerate(cols)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("r")) for i, c in enumerate(cols)])
    return one.select(F.explode(cells).alias("c")).select("c.*").orderBy(F.abs("r").desc_nulls_last(), "column").limit(top)
