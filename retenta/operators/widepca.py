"""Principal components of a wide sparse table by a randomised range finder.

The table is given by its entries (row, column, value); absent entries are zero.
No matrix of columns x columns and no vector of all columns exists anywhere:
rows and columns are keys of joins and grouped sums, each with an array of one
number per direction, and the driver holds directions x directions only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from retenta.session import release, settle


@dataclass
class WidePca:
    """components (component from 1, variance), loadings (column, mean, loadings), and the number of rows."""

    components: DataFrame
    loadings: DataFrame
    rows: int


def _normal(key: str, seed: int, j: int) -> Column:
    """A standard normal number that depends on the key's value alone."""
    u, v = ((F.pmod(F.xxhash64(key, F.lit(seed), F.lit(2 * j + i)), F.lit(1 << 53)) + 1) / F.lit(float(1 << 53)) for i in (0, 1))
    return F.sqrt(-2 * F.ln(u)) * F.cos(v * F.lit(2 * np.pi))


def _gram(df: DataFrame, col: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products of the array's places, and sums of the places; partial sums per task."""
    def partial(batches):
        total = np.zeros((size + 1, size))
        for pdf in batches:
            if len(pdf):
                y = np.vstack(pdf[col].to_numpy())
                total[:size] += y.T @ y
                total[size] += y.sum(axis=0)
        i, j = np.divmod(np.arange(total.size), size)
        yield pd.DataFrame({"i": i, "j": j, "g": total.ravel()})

    sums = df.select(col).mapInPandas(partial, "i long, j long, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).toPandas()
    out = np.zeros((size + 1, size))
    out[sums["i"], sums["j"]] = sums["g"]
    return out[:size], out[size]


def _whiten(gram: np.ndarray) -> np.ndarray:
    """T so that Y T has orthonormal columns, directions of no extent left out."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > max(values.max(initial=0.0), 0.0) * 1e-13
    return vectors[:, keep] / np.sqrt(values[keep])


def _rotated(df: DataFrame, col: str, by: np.ndarray, shift: np.ndarray) -> DataFrame:
    """(column, mean, z): the array times `by`, less mean x shift."""
    def turn(batches):
        for pdf in batches:
            if len(pdf):
                z = np.vstack(pdf[col].to_numpy()) @ by - np.outer(pdf["mean"], shift)
                yield pd.DataFrame({"column": pdf["column"], "mean": pdf["mean"], "z": list(z)})

    kind = df.schema["column"].dataType.simpleString()
    return df.select("column", "mean", col).mapInPandas(turn, f"column {kind}, mean double, z array<double>")


def fit_wide_pca(entries: DataFrame, k: int, rows: int | None = None, extra: int = 10, steps: int = 4, seed: int = 42) -> WidePca:
    """The first k principal components of the centred table.

    `entries` has (row, column, value), at most one entry per place; NULL values
    count as zero and entries with a NULL row or column are left out.  `rows`
    counts rows without entries too (default: rows that occur).  k + extra
    random numbers per column, made from its name, span the start; each of `steps` rounds multiplies
    by the table and its transpose, orthonormal in between.  With k + extra at
    or above the rank the variances are exact, and at the number of columns one round does.  A row's entries
    lie in one file, so a task sums them before they are shuffled.  Variances divide by rows - 1.
    Each component's sign makes its loadings' sum positive.  A table of lower rank
    than k may give fewer components; an empty one has none.
    """
    spark = entries.sparkSession
    cells = settle(entries.where("row is not null and column is not null").select(
        "row", "column", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value")).repartition("row"), "pca-entries")
    present = cells.select("row").distinct().count()
    n = max(rows or present, present)
    sums = settle(cells.groupBy("column").agg((F.sum("value") / F.lit(float(max(n, 1)))).alias("mean")), "pca-means")
    columns = sums.count()
    size = min(k + extra, columns, n)
    if size == columns:  # the start spans the whole space: one more round only makes it orthonormal
        steps = min(steps, 1)
    kind = entries.schema["column"].dataType.simpleString()
    if size == 0:
        return WidePca(spark.createDataFrame([], "component int, variance double"),
                       spark.createDataFrame([], f"column {kind}, mean double, loadings array<double>"), n)
    turned = settle(sums.withColumn("z", F.array(*[_normal("column", seed, j) for j in range(size)])), "pca-columns")
    for _ in range(steps + 1):
        means = turned.agg(*[F.sum(F.col("mean") * F.col("z")[j]).alias(str(j)) for j in range(size)]).first()
        shift = np.array([means[j] for j in range(size)])
        dots = cells.join(turned.select("column", "z"), "column").groupBy("row").agg(
            F.array(*[F.sum(F.col("value") * F.col("z")[j]) - F.lit(float(shift[j])) for j in range(size)]).alias("y"))
        dots = settle(dots, "pca-rows")
        gram, total = _gram(dots, "y", size)
        # rows without entries are zero before centring
        gram, total = gram + (n - present) * np.outer(shift, shift), total - (n - present) * shift
        turn = _whiten(gram)
        if not turn.shape[1]:  # a constant table: every variance is zero
            turned = settle(_rotated(turned, "z", np.zeros((size, size)), np.zeros(size)), "pca-columns")
            break
        back = cells.join(dots, "row").groupBy("column").agg(
            F.array(*[F.sum(F.col("value") * F.col("y")[j]) for j in range(size)]).alias("s")).join(sums, "column")
        # columns' sums against centred rows; the mean's share is taken off in the rotation
        after = settle(_rotated(back, "s", turn, total @ turn), "pca-columns")
        release(turned)
        release(dots)
        turned, size = after, turn.shape[1]
    values, vectors = np.linalg.eigh(_gram(turned, "z", size)[0])
    order = np.argsort(-values)[:k]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    rotation = vectors / np.sqrt(np.where(values > 0, values, 1.0))
    rotation = rotation * np.where(_gram(turned, "z", size)[1] @ rotation < 0, -1.0, 1.0)
    loadings = settle(_rotated(turned, "z", rotation, np.zeros(len(order))).select("column", "mean", F.col("z").alias("loadings")), "pca-loadings")
    for done in (turned, cells, sums):
        release(done)
    parts = [(i + 1, float(v / max(n - 1, 1))) for i, v in enumerate(values)]
    return WidePca(spark.createDataFrame(parts, "component int, variance double"), loadings, n)


def project(entries: DataFrame, fit: WidePca) -> DataFrame:
    """(row, scores): each row with entries in the space of the components; columns that the fit has not seen add nothing."""
    k = fit.components.count()
    base = fit.loadings.agg(*[F.sum(F.col("mean") * F.col("loadings")[j]).alias(str(j)) for j in range(k)]).first()
    value = F.coalesce(F.col("value").cast("double"), F.lit(0.0))
    seen = entries.join(fit.loadings, "column", "left").where("row is not null").groupBy("row")
    return seen.agg(F.array(*[F.coalesce(F.sum(value * F.col("loadings")[j]), F.lit(0.0)) - F.lit(base[j] or 0.0) for j in range(k)]).alias("scores"))
