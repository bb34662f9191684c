"""Mutual information of numeric features and a class by nearest neighbours.

Every point's radius is the distance to its k-th neighbour of the same class,
and its count the points of any class within less than that.  In one dimension
both are questions of order.  Points with the same feature, class and value are
one row; ordered rows get a number, blocks of numbers with k rows of the blocks
beside them hold every k-th neighbour, and the counts are differences of two
ranks, found by running totals over values and interval ends together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from retenta.plans.order import running_totals
from retenta.session import settle

BLOCK = 50_000  # rows that a task orders at once, about


def digamma(n: Column) -> Column:
    """Digamma of a whole number from 1 on, to 11 digits: by its expansion at n + 8, less the steps back."""
    x = n + F.lit(8.0)
    inv2 = 1 / (x * x)
    tail = inv2 * (F.lit(1 / 12) - inv2 * (F.lit(1 / 120) - inv2 * (F.lit(1 / 252) - inv2 * F.lit(1 / 240))))
    steps = F.lit(0.0)
    for i in range(8):
        steps = steps + 1 / (n + F.lit(float(i)))
    return F.ln(x) - 1 / (2 * x) - tail - steps


def _rank(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles, neighbours one apart; its own inverse on bits."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, np.int64(-(2**63)) - bits, bits)


def _double(rank: np.ndarray) -> np.ndarray:
    return np.where(rank < 0, np.int64(-(2**63)) - rank, rank).view(np.float64)


def _edge(v: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Smallest double t with t - v >= r, in double arithmetic, for r > 0; halving between v and v + 2 r."""
    below, at = _rank(v), _rank(v + 2 * r)
    while (apart := below + 1 < at).any():
        mid = (below >> 1) + (at >> 1) + (below & at & 1)  # the sum of both could overflow
        enough = _double(mid) - v >= r
        at, below = np.where(apart & enough, mid, at), np.where(apart & ~enough, mid, below)
    return _double(at)


def kth_distance(value: np.ndarray, n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """For ascending distinct values with multiplicities: the distance to the k-th nearest other point (inf where the rows end before)."""
    most = int(k.max(initial=0))
    left, right = np.arange(len(value)), np.arange(len(value))
    have, radius = n - 1.0, np.zeros(len(value))
    for _ in range(most):
        open_ = have < k
        if not open_.any():
            break
        to_left = np.where(left > 0, value - value[np.maximum(left - 1, 0)], np.inf)
        to_right = np.where(right < len(value) - 1, value[np.minimum(right + 1, len(value) - 1)] - value, np.inf)
        go = open_ & (to_left <= to_right) & (left > 0)
        take = open_ & ~go & (right < len(value) - 1)
        radius = np.where(open_, np.minimum(to_left, to_right), radius)
        left, right = left - go, right + take
        have = have + np.where(go, n[left], 0) + np.where(take, n[right], 0)
    return np.where(have < k, np.inf, radius)


def neighbour_mutual_information(df: DataFrame, features: Sequence[str], label: str = "label", k: int = 3, block: int = BLOCK) -> DataFrame:
    """(feature, score): the k-nearest-neighbour estimate in nats, 0 at least; 0 for a feature without two rows of a class.

    Rows without a label, or without a number for a feature, are left out for
    that feature; so are classes of one row.  Equal values are at distance 0: where the
    k nearest all equal the point, all points of its class that do, itself
    included, take the place of k, against all points of any class that do.
    """
    features = list(features)
    cells = F.array(*[F.struct(F.lit(i).alias("f"), (F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias("v")) for i, c in enumerate(features)])
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("c"), F.explode(cells).alias("x")).select("c", "x.f", "x.v")
    rows = rows.where("v is not null and not isnan(v) and abs(v) < double('infinity')").groupBy("f", "c", "v").agg(F.count(F.lit(1)).alias("n"))
    points = settle(rows, "neighbours")
    # one row per feature and class
    sizes = points.groupBy("f", "c").agg(F.sum("n").alias("size")).where("size > 1").withColumn("k", F.least(F.lit(k), F.col("size") - 1))
    points = points.join(sizes, ["f", "c"])
    numbered = running_totals(points.withColumn("c", F.col("c").cast("string")), "v", {"at": F.lit(1).cast("long")}, by=["f", "c"])
    placed = numbered.withColumn("own", F.floor((F.col("at") - 1) / F.lit(block)))
    near = F.array_distinct(F.array("own", F.floor((F.col("at") - 1 - F.lit(k)) / F.lit(block)), F.floor((F.col("at") - 1 + F.lit(k)) / F.lit(block))))
    copies = placed.withColumn("block", F.explode(near))

    def radii(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("v")
        v = g["v"].to_numpy()
        r = kth_distance(v, g["n"].to_numpy(), g["k"].to_numpy())
        own = (g["own"] == g["block"]).to_numpy()
        g, v, r = g[own], v[own], r[own]
        same = r == 0  # then the points at v itself
        step = np.where(same, 1.0, r)
        lo, hi = -_edge(-v, step), _edge(v, step)  # what lies between is nearer than r
        return pd.DataFrame({"f": g["f"], "c": g["c"], "v": v, "n": g["n"], "k": np.where(same, g["n"], g["k"]), "size": g["size"],
                             "lo": np.where(same, v, lo), "hi": np.where(same, v, hi), "same": same})

    found = copies.groupBy("f", "c", "block").applyInPandas(radii, "f int, c string, v double, n long, k long, size long, lo double, hi double, same boolean")
    found = settle(found, "neighbour-radii")
    # ranks: what is below hi, less what is at lo or below (below lo, where the interval is the value itself); ends lie between the values by `late`
    ask = found.select("f", F.explode(F.array(
        F.struct(F.col("hi").alias("x"), F.when(F.col("same"), 2).otherwise(0).alias("late"), F.lit(1).alias("sign")),
        F.struct(F.col("lo").alias("x"), F.when(F.col("same"), 0).otherwise(2).alias("late"), F.lit(-1).alias("sign")))).alias("e"),
        F.struct("c", "v", "n", "k", "size").alias("row")).select("f", "e.*", "row", F.lit(0).cast("long").alias("n"))
    held = points.groupBy("f", "v").agg(F.sum("n").alias("n")).select(
        "f", F.col("v").alias("x"), F.lit(1).alias("late"), F.lit(0).alias("sign"), F.lit(None).cast(ask.schema["row"].dataType).alias("row"), "n")
    ranks = running_totals(settle(ask.unionByName(held), "neighbour-ends"), "x", {"below": F.col("n")}, tie="late", by=["f"])
    each = ranks.where("sign <> 0").groupBy("f", "row").agg(F.sum(F.col("sign") * F.col("below")).alias("m")).select("f", "row.*", "m")
    w = F.col("n")
    parts = each.groupBy("f").agg(F.sum(w).alias("all"), *[(F.sum(w * digamma(F.col(c).cast("double"))) / F.sum(w)).alias(f"p{c}") for c in ("k", "size", "m")])
    score = F.greatest(F.lit(0.0), digamma(F.col("all")) + F.col("pk") - F.col("psize") - F.col("pm"))
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "f int, feature string")
    return names.join(parts, "f", "left").select("feature", F.coalesce(score, F.lit(0.0)).alias("score"))
