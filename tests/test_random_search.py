"""The random search reads its table as often for many folds as for few, and finds what Spark's cross-validation finds."""

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from retenta.operators import models as M
from retenta.operators.splits import stratified_folds


def _rows(spark, read):
    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 100
    rows = spark.range(400).select("id", (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 2 + noise).alias("x"), noise.alias("y"))
    return M.assemble(rows.mapInArrow(count, rows.schema), ["x", "y"], ["id", "label"])


def test_the_table_is_read_as_often_for_more_folds(spark):
    passes = []
    for folds in (2, 5):
        read = spark.sparkContext.accumulator(0)
        M.random_search(M.forest(numTrees=2), {"maxDepth": [1, 2], "minInstancesPerNode": [1, 2]}, _rows(spark, read), "id", folds=folds)
        passes.append(read.value)
    assert passes[0] == passes[1], passes


def test_scores_are_those_of_the_cross_validator(spark):
    df = _rows(spark, spark.sparkContext.accumulator(0)).localCheckpoint()
    est, grid = M.forest(numTrees=3), {"maxDepth": [1, 3], "minInstancesPerNode": [1]}
    got = M.random_search(est, grid, df, "id", folds=3)
    maps = [{est.maxDepth: d, est.minInstancesPerNode: 1} for d in (1, 3)]
    want = CrossValidator(estimator=est, estimatorParamMaps=maps, numFolds=3, foldCol="fold", seed=42,
                          evaluator=BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", numBins=0)).fit(
        stratified_folds(df, "id", "label", 3, 42))
    assert np.allclose(sorted(got.avgMetrics), sorted(want.avgMetrics)) and np.allclose(sorted(got.stdMetrics), sorted(want.stdMetrics))
    assert got.bestModel.getOrDefault("maxDepth") == want.bestModel.getOrDefault("maxDepth")
