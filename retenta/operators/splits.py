"""Temporal, stratified, random and cross-validation splits; summaries and checks.

Random splits order rows by md5(seed|id): reproducible on any cluster layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retenta.functions.expr import hash_key, hash_number, ratio
from retenta.params import SplitParams
from retenta.plans.order import with_rank


def temporal_split(df: DataFrame, date: str, ident: str, params: SplitParams = SplitParams()) -> DataFrame:
    """Add `split`: the latest test_size rows are test, val_size of the rest val, earliest train."""
    n = df.agg(F.count(F.lit(1))).scalar()
    n_test = F.floor(n * F.lit(params.test_size))
    n_val = F.floor((n - n_test) * F.lit(params.val_size))
    ranked = with_rank(df, date, ident, name="_rank")
    name = F.when(F.col("_rank") <= n - n_test - n_val, "train").when(F.col("_rank") <= n - n_test, "val").otherwise("test")
    return ranked.withColumn("split", name).drop("_rank")


def _cut(n: Column, share: float) -> Column:
    return F.floor(n * F.lit(share) + F.lit(0.5))


def random_split(df: DataFrame, ident: str, params: SplitParams = SplitParams(), by: Sequence[str] = ()) -> DataFrame:
    """Add `split` by hash rank, within each class of `by` when given."""
    # a struct of labels is never NULL, so rows with NULL labels are a class like any other
    df = df.withColumn("_h", hash_number(hash_key(params.seed, F.col(ident)))).withColumn("_class", F.struct(*by) if by else F.lit(0))
    ranked = with_rank(df, "_h", ident, by=["_class"] if by else [], name="_rank")
    sizes = df.groupBy(*(["_class"] if by else [])).agg(F.count(F.lit(1)).alias("_n"))
    ranked = ranked.join(sizes, "_class") if by else ranked.withColumn("_n", sizes.scalar())
    n_test = _cut(F.col("_n"), params.test_size)
    n_held = _cut(F.col("_n"), params.test_size + params.val_size)
    name = F.when(F.col("_rank") <= n_test, "test").when(F.col("_rank") <= n_held, "val").otherwise("train")
    return ranked.withColumn("split", name).drop("_h", "_rank", "_n", "_class")


def stratified_split(df: DataFrame, ident: str, label: str, params: SplitParams = SplitParams()) -> DataFrame:
    return random_split(df, ident, params, [label])


def shuffle_splits(df: DataFrame, ident: str, label: str, n_splits: int = 5, seed: int = 42) -> DataFrame:
    """(split, id, label, role): independent stratified draws of 1/n_splits as validation; draws may overlap."""
    rows = df.select(ident, label).withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.col("split").cast("string"), F.lit("|"), F.col(ident).cast("string")))
    rows = rows.withColumn("_h", hash_number(key))
    ranked = with_rank(rows.withColumn("_class", F.struct(label)), "_h", ident, by=["split", "_class"], name="_rank")
    sizes = df.groupBy(F.struct(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    held = _cut(F.col("_n"), 1 / n_splits)
    return ranked.join(sizes, "_class").select(
        "split", ident, label, F.when(F.col("_rank") <= held, "val").otherwise("train").alias("role"))


def stratified_folds(df: DataFrame, ident: str, label: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add `fold` 0..k-1: disjoint, class shares kept (hash rank within class, modulo k)."""
    keyed = df.withColumn("_h", hash_number(hash_key(seed, F.col(ident)))).withColumn("_class", F.struct(label))
    ranked = with_rank(keyed, "_h", ident, by=["_class"], name="_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_h", "_rank", "_class")


def sample_rows(df: DataFrame, ident: str, n: int, seed: int = 42) -> DataFrame:
    """n reproducible rows: a top-k by hash, no full sort."""
    return df.withColumn("_h", hash_key(seed, F.col(ident))).orderBy("_h", ident).limit(n).drop("_h")


def split_summary(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows, share of all rows and class shares per split."""
    cells = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.groupBy(split).agg(F.sum("n").alias("split_rows"))
    total = sizes.agg(F.sum("split_rows")).scalar()
    return cells.join(sizes, split).select(
        split, label, "n", "split_rows", (F.col("split_rows") / total).alias("proportion"),
        (F.col("n") / F.col("split_rows")).alias("label_share"))


def class_drift(df: DataFrame, label: str, split: str = "split", tolerance: float = 0.05) -> DataFrame:
    """Per training class: share in train, val, test, and whether it moves by more than the tolerance."""
    def share(name: str) -> Column:
        inside = F.col(split) == name
        return F.sum(F.when(inside, F.col("n")).otherwise(F.lit(0)))

    cells = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    totals = cells.agg(F.struct(*[share(s).alias(s) for s in ("train", "val", "test")])).scalar()
    per = cells.groupBy(label).agg(*[share(s).alias(f"_{s}") for s in ("train", "val", "test")]).withColumn("t", totals)
    out = per.where("_train > 0").select(label, *[
        F.coalesce(ratio(F.col(f"_{s}"), F.col(f"t.{s}")), F.lit(0.0)).alias(f"{s}_share") for s in ("train", "val", "test")])
    moved = (F.abs(F.col("train_share") - F.col("val_share")) > tolerance) | (F.abs(F.col("train_share") - F.col("test_share")) > tolerance)
    return out.withColumn("drifts", moved)


def temporal_leakage(df: DataFrame, date: str, split: str = "split") -> DataFrame:
    """Date ranges per split and whether a later split starts at or before an earlier one ends."""
    def edge(fn, name: str) -> Column:
        return fn(F.when(F.col(split) == name, F.col(date)))

    one = df.agg(edge(F.max, "train").alias("train_end"), edge(F.min, "val").alias("val_start"),
                 edge(F.max, "val").alias("val_end"), edge(F.min, "test").alias("test_start"))
    return one.withColumns({"train_val_overlap": F.col("train_end") >= F.col("val_start"),
                            "val_test_overlap": F.col("val_end") >= F.col("test_start")})
