"""Rows with NULL labels and categories stay and form a class of their own."""

from pyspark.sql import functions as F

from retenta.operators.splits import shuffle_splits, stratified_folds, stratified_split
from retenta.operators.transform import target_encode_cross_fitted


def rows(spark):
    return spark.range(50).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("label"))


def test_splits_keep_null_labels(spark):
    df = rows(spark)
    got = stratified_split(df, "id", "label")
    assert got.count() == 50 and got.where("label is null").select("split").distinct().count() > 1
    assert stratified_folds(df, "id", "label").where("label is null").groupBy("fold").count().count() == 5
    assert shuffle_splits(df, "id", "label", 5).count() == 250


def test_null_is_a_category(spark):
    df = spark.range(40).select("id", F.when(F.col("id") % 4 > 0, F.lit("a")).alias("c"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                                (F.col("id") % 5).cast("int").alias("fold"))
    got = target_encode_cross_fitted(df, "c", "y", "fold")
    assert got.count() == 40 and got.where("encoding is null").count() == 0
