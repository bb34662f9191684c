"""Isotonic regression in parallel.

The fit is the slope of the greatest convex minorant of the running sums, and a
minorant of minorants is one: score ranges pool adjacent violators on their own,
then neighbouring ranges pool theirs together, pairs shifted by one from round
to round, until no range starts below the end of the one before it.  A pooled
block belongs to the range it begins in and ranges that are used up vanish, so a
task never holds more than two of the first ranges, and data in which everything
pools is merged like a tree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from retenta.plans.order import with_positions
from retenta.session import settle

RANGE = 100_000  # distinct scores of a first range, about
_BLOCKS = "range int, lo double, hi double, w double, s double"


def pool(w: np.ndarray, s: np.ndarray) -> np.ndarray:
    """First places of the blocks that adjacent violators pool to; w are weights, s weighted sums."""
    first: list[int] = []
    sw: list[float] = []
    ss: list[float] = []
    for i, (a, b) in enumerate(zip(w.tolist(), s.tolist())):
        at = i
        while first and ss[-1] * a >= b * sw[-1]:  # the mean before is not smaller
            a, b, at = a + sw.pop(), b + ss.pop(), first.pop()
        first.append(at)
        sw.append(a)
        ss.append(b)
    return np.array(first, np.int64)


def _pooled(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("lo")
    if g.empty:
        return g[["range", "lo", "hi", "w", "s"]]
    at = pool(g["w"].to_numpy(), g["s"].to_numpy())
    last = np.append(at[1:], len(g)) - 1
    return pd.DataFrame({"range": g["range"].to_numpy()[at], "lo": g["lo"].to_numpy()[at], "hi": g["hi"].to_numpy()[last],
                         "w": np.add.reduceat(g["w"].to_numpy(), at), "s": np.add.reduceat(g["s"].to_numpy(), at)})


@dataclass
class Isotonic:
    """blocks: (range, lo, hi, w, s), each with the value s / w from its lowest to its highest score; edges: (range, lo) ascending, a row a range."""

    blocks: DataFrame
    edges: list[tuple[int, float]]


def fit_isotonic(df: DataFrame, score: str = "score", label: str = "label", weight: str | None = None, per_range: int = RANGE) -> Isotonic:
    """Least-squares increasing function of the score; rows without score, label or a positive weight take no part.

    The driver receives two values per range.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    x = F.col(score).cast("double")
    rows = df.select((x + F.lit(0.0)).alias("x"), F.col(label).cast("double").alias("y"), w.alias("w")).where(
        "x is not null and not isnan(x) and y is not null and w > 0")
    distinct = settle(rows.groupBy("x").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("s")), "isotonic-scores")
    ranges = max(1, -(-distinct.count() // per_range))
    dealt = distinct.repartitionByRange(ranges, "x").select(F.spark_partition_id().alias("range"), F.col("x").alias("lo"), F.col("x").alias("hi"), "w", "s")
    blocks, shift = settle(dealt.groupBy("range").applyInPandas(_pooled, _BLOCKS), "isotonic"), 0
    while True:
        ends = blocks.groupBy("range").agg(F.min("lo").alias("lo"), F.min_by(F.col("s") / F.col("w"), "lo").alias("a"),
                                           F.max_by(F.col("s") / F.col("w"), "lo").alias("z")).orderBy("lo").collect()
        number = {r["range"]: i for i, r in enumerate(ends)}
        bad = [i for i in range(1, len(ends)) if ends[i - 1]["z"] >= ends[i]["a"]]
        if not bad:
            return Isotonic(blocks, [(r["range"], r["lo"]) for r in ends])
        if not any(i % 2 != shift for i in bad):
            shift = 1 - shift  # no violation lies inside a pair: pair the other way
        order = F.create_map(*[F.lit(v) for item in number.items() for v in item])[F.col("range")].cast("int")
        pairs = blocks.withColumn("range", order).withColumn("pair", F.floor((F.col("range") + F.lit(shift)) / F.lit(2)))
        blocks, shift = settle(pairs.groupBy("pair").applyInPandas(lambda g: _pooled(g.drop(columns="pair")), _BLOCKS), "isotonic"), 1 - shift


def apply_isotonic(df: DataFrame, model: Isotonic, score: str = "score", name: str = "calibrated") -> DataFrame:
    """df with the fitted value of its score: linear between blocks, the end values beyond; null without a score or a fit.

    Distinct scores meet the blocks of their range and come back by the score.
    """
    if not model.edges:
        return df.withColumn(name, F.lit(None).cast("double"))
    cuts = F.array(*[F.lit(lo) for _, lo in model.edges[1:]]).cast("array<double>")
    asked = df.select((F.col(score).cast("double") + F.lit(0.0)).alias("_x")).where("_x is not null and not isnan(_x)").distinct()
    placed = with_positions(asked.withColumn("_cuts", cuts), [], len(model.edges) - 1, upto=[("_x", "_cuts", "_place")]).select("_x", "_place")
    number = F.create_map(*[F.lit(v) for i, (r, _) in enumerate(model.edges) for v in (r, i)])[F.col("range")]
    points = model.blocks.select(number.alias("_place"), "lo", "hi", (F.col("s") / F.col("w")).alias("y"))
    # a score after a range's last block lies between that and the next range's first one
    first = points.groupBy("_place").agg(F.min_by(F.struct("lo", "hi", "y"), "lo").alias("p")).select((F.col("_place") - 1).alias("_place"), "p.*")
    points = points.unionByName(first.where("_place >= 0"))

    def read(asked: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("lo")
        x = np.column_stack([points["lo"], points["hi"]]).ravel()
        return pd.DataFrame({"_x": asked["_x"], "_y": np.interp(asked["_x"], x, np.repeat(points["y"].to_numpy(), 2))})

    values = placed.groupBy("_place").cogroup(points.groupBy("_place")).applyInPandas(read, "_x double, _y double")
    key = F.col(score).cast("double") + F.lit(0.0)
    return df.join(values, key == F.col("_x"), "left").withColumnRenamed("_y", name).drop("_x")
