"""Second-order boosted trees for two classes.

Feature values become bin numbers once.  Every level of a tree is one pass:
tasks add up gradient, Hessian and rows per (node, feature, bin) of their own
rows, Spark sums these and runs along the bins of each (node, feature), and the
split with the largest regularised gain per node comes back: a row a node, at
any size of the data.  Rows are never moved.  Margins of finished trees are
written every few trees, so a pass scores only the last ones again and a lost
executor costs no more than these.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from retenta.plans.quantiles import fit_quantiles
from retenta.plans.trees import Trees
from retenta.session import settle

EVERY = 10         # trees between two written tables of margins
DENSE = 1 << 22    # sums that a task holds as plain arrays; with more it holds those of occupied cells


def fit_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Ascending thresholds per feature: its exact quantiles, at most bins - 1 of them, without the largest value."""
    found = fit_quantiles(df, list(features), [i / bins for i in range(1, bins)])
    tops = df.agg(*[F.max(F.col(f"`{c}`").cast("double")) for c in features]).first()
    return [np.array(sorted({float(v) for v in found[c] if v is not None and (top is None or v < top)})) for c, top in zip(features, tops)]


def _binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bin b holds values above cut b - 1 and up to cut b; no value goes to the last bin, as trees send it right."""
    return np.stack([np.where(np.isnan(x[:, j]), len(c), np.searchsorted(c, x[:, j], side="left")) for j, c in enumerate(cuts)], axis=1)


def _floats(batch: pa.RecordBatch, first: int, last: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(first, last)])


def histograms(rows: DataFrame, cuts: Sequence[np.ndarray], trees: Trees, grown: Trees, leaves: Sequence[int], weight: float,
               share: float, seed: int) -> DataFrame:
    """(node, feature, bin, g, h, n): summed gradients, Hessians and rows at the given leaves of `grown`.

    rows: id hash, label, margin, then the features.  `trees` are finished ones
    that the margin does not have yet; `share` of the rows, drawn by hash for
    the tree, take part; weight multiplies the rows of class 1.
    """
    width = max(len(c) for c in cuts) + 1
    k = len(cuts)
    leaves = np.array(leaves)
    place = np.full(len(grown.feature), -1)
    place[leaves] = np.arange(len(leaves))
    size = len(leaves) * k * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, sums = np.empty(0, np.int64), np.zeros((3, size if size <= DENSE else 0))
        for b in batches:
            key, y, margin = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if share < 1:
                draw = (key.astype(np.uint64) ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
                kept = (draw >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 < share
            else:
                kept = np.ones(len(y), bool)
            x = _floats(b, 3, 3 + k)[kept]
            if not len(x):
                continue
            y = y[kept].astype(np.float64)
            p = 1 / (1 + np.exp(-(margin[kept] + trees.margin(x))))
            w = np.where(y == 1, weight, 1.0)
            node = grown.roots[0] + np.zeros(len(x), np.int64)
            while (inner := grown.feature[node] >= 0).any():
                low = x[np.arange(len(x)), np.maximum(grown.feature[node], 0)] <= grown.threshold[node]
                node = np.where(inner, np.where(low, grown.left[node], grown.right[node]), node)
            at = place[node] >= 0
            x, y, p, w, node = x[at], y[at], p[at], w[at], node[at]
            cell = ((place[node][:, None] * k + np.arange(k)) * width + _binned(x, cuts)).ravel()
            parts = np.repeat(np.stack([w * (p - y), w * p * (1 - p), np.ones(len(x))]), k, axis=1)
            if size <= DENSE:
                sums += np.stack([np.bincount(cell, v, size) for v in parts])
            else:  # the same sums, kept for the cells that rows fall into
                full, at = np.unique(np.concatenate([full, cell]), return_inverse=True)
                sums = np.stack([np.bincount(at, v, len(full)) for v in np.concatenate([sums, parts], axis=1)])
        if size <= DENSE:
            full = np.flatnonzero(sums[2])
            sums = sums[:, full]
        yield pa.RecordBatch.from_arrays(
            [pa.array(leaves[full // (k * width)].astype(np.int32)), pa.array((full // width % k).astype(np.int32)), pa.array((full % width).astype(np.int32)),
             *(pa.array(s) for s in sums)], ["node", "feature", "bin", "g", "h", "n"])

    part = rows.mapInArrow(run, "node int, feature int, bin int, g double, h double, n double")
    # parts are sums already; dealt by (node, feature) once for the sum and for the run along the bins
    return part.repartition("node", "feature").groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])


# The run along a (node, feature)'s bins and the best split of a node, as one text: a pass is planned for every level of every tree.
_BEST = """
WITH run AS (
  SELECT node, feature, bin, sum(g) OVER left AS gl, sum(h) OVER left AS hl, sum(g) OVER whole AS g, sum(h) OVER whole AS h, max(bin) OVER whole AS last
  FROM {{hist}}
  WINDOW left AS (PARTITION BY node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), whole AS (PARTITION BY node, feature)
),
gained AS (
  SELECT *, (gl * gl / (hl + {ridge}) + (g - gl) * (g - gl) / (h - hl + {ridge}) - g * g / (h + {ridge})) / 2 AS gain,
         bin < last AND hl >= {least} AND h - hl >= {least} AND array_contains({columns}, feature) AS fits
  FROM run
)
SELECT node, first(g) AS g, first(h) AS h,
       max(CASE WHEN fits AND gain > 1e-12 THEN struct(round(gain, 9) AS near, -feature AS f, -bin AS b, gain, gl, hl) END) AS best
FROM gained GROUP BY node
"""


def best_splits(hist: DataFrame, ridge: float, least_hessian: float, columns: Sequence[int]) -> DataFrame:
    """(node, g, h, best): per open leaf its sums and its best split, null where none gains.

    best has gain, the left side's sums gl and hl, and the negated feature f and
    bin b; gains that agree to nine digits go to the smaller feature, then bin.
    """
    text = _BEST.format(ridge=f"{float(ridge)!r}D", least=f"{float(least_hessian)!r}D", columns=f"array({', '.join(str(int(c)) for c in columns)})")
    return hist.sparkSession.sql(text, hist=hist)


class Boosted:
    """Fitted trees over named features."""

    def __init__(self, trees: Trees, features: Sequence[str], made: list[tuple]) -> None:
        self.trees, self.features, self.made = trees, list(features), made

    def splits(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, threshold, gain, low_value, high_value): every split, and what its sides would answer as leaves."""
        return spark.createDataFrame(self.made, "tree int, node int, feature int, threshold double, gain double, low_value double, high_value double")

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """`keep` columns, margin and score (probability of class 1); the features' nulls go right."""
        trees, k, n = self.trees, len(keep), len(self.features)
        schema = df.select(*keep).schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                margin = trees.margin(_floats(b, k, k + n)) if len(b) else np.empty(0)
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(k)), pa.array(margin), pa.array(1 / (1 + np.exp(-margin)))],
                                                 [*b.schema.names[:k], "margin", "score"])

        out = schema.add("margin", "double").add("score", "double")
        return df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(self.features)]).mapInArrow(run, out)

    def importance(self) -> list[tuple[str, float]]:
        """Summed gain per feature, as shares, largest first."""
        total = {c: 0.0 for c in self.features}
        for _, _, f, _, gain, _, _ in self.made:
            total[self.features[f]] += gain
        whole = sum(total.values()) or 1.0
        return sorted(((c, g / whole) for c, g in total.items()), key=lambda r: (-r[1], r[0]))


def _grow(trees: list[Trees], base: float) -> Trees:
    """One table of several trees."""
    sizes = np.cumsum([0, *(len(t.feature) for t in trees)])

    def shifted(name: str) -> np.ndarray:
        return np.concatenate([np.where(getattr(t, name) >= 0, getattr(t, name) + s, -1) for t, s in zip(trees, sizes)] or [np.empty(0, np.int64)])

    def joined(name: str, kind) -> np.ndarray:
        return np.concatenate([getattr(t, name) for t in trees] or [np.empty(0, kind)])

    return Trees(sizes[:-1].astype(np.int64), joined("feature", np.int64), joined("threshold", float), shifted("left"), shifted("right"),
                 joined("value", float), joined("cover", float), base)


def boost(df: DataFrame, ident: str, features: Sequence[str], label: str = "label", trees: int = 100, depth: int = 6, eta: float = 0.3,
          ridge: float = 1.0, least_hessian: float = 1.0, least_gain: float = 0.0, bins: int = 256, subsample: float = 1.0,
          column_share: float = 1.0, positive_weight: float | None = None, seed: int = 42) -> Boosted:
    """Boosted trees on log loss by gradients and Hessians.

    label is 0 or 1, rows without one take no part.  positive_weight is by
    default the ratio of the classes' rows, which balances them (1 with one class).  A leaf's value
    is -eta * g / (h + ridge); a split needs least_hessian on both sides and
    more gain than least_gain.  subsample draws rows per tree by a hash of the
    id, column_share draws features per tree.  Values without a number (null,
    NaN) go right.  Without rows there are no trees and the margin is 0.
    """
    features = list(features)
    rows = df.where(F.col(label).isNotNull()).select(
        F.xxhash64(ident).alias("_key"), F.col(label).cast("double").alias("_y"), F.lit(0.0).alias("_margin"),
        *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(features)])
    rows = settle(rows, "boost")
    names = rows.columns[3:]
    n, positive = rows.agg(F.count(F.lit(1)), F.sum("_y")).first()
    if not n:
        return Boosted(_grow([], 0.0), features, [])
    weight = positive_weight if positive_weight is not None else (n - positive) / positive if 0 < positive < n else 1.0
    cuts = fit_cuts(rows, names, bins)
    rng = np.random.default_rng(seed)
    done: list[Trees] = []
    fresh: list[Trees] = []
    made: list[tuple] = []
    for number in range(trees):
        used = sorted(rng.choice(len(features), max(1, round(column_share * len(features))), replace=False).tolist())
        tree = Trees(*(np.array([v]) for v in (0, -1, 0.0, -1, -1, 0.0, 0.0)))
        draw = int(rng.integers(1 << 62))
        pending = _grow(fresh, 0.0)
        leaves = [0]
        for _ in range(depth):
            found = best_splits(histograms(rows, cuts, pending, tree, leaves, weight, subsample, draw), ridge, least_hessian, used).collect()
            parts = {name: getattr(tree, name).tolist() for name in ("feature", "threshold", "left", "right", "value", "cover")}
            leaves = []
            for r in sorted(found, key=lambda r: r["node"]):
                at, s = r["node"], r["best"]
                parts["value"][at], parts["cover"][at] = -eta * r["g"] / (r["h"] + ridge), r["h"]
                if s is None or s["gain"] <= least_gain:
                    continue
                new, f = len(parts["feature"]), -s["f"]
                parts["feature"][at], parts["threshold"][at], parts["value"][at] = f, float(cuts[f][-s["b"]]), 0.0
                parts["left"][at], parts["right"][at] = new, new + 1
                for g, h in ((s["gl"], s["hl"]), (r["g"] - s["gl"], r["h"] - s["hl"])):  # a child's sums are known already
                    for name, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", -eta * g / (h + ridge)), ("cover", h)):
                        parts[name].append(v)
                leaves += [new, new + 1]
                made.append((number, at, f, parts["threshold"][at], s["gain"], parts["value"][new], parts["value"][new + 1]))
            tree = Trees(np.array([0]), *(np.array(parts[name]) for name in ("feature", "threshold", "left", "right", "value", "cover")))
            if not leaves:
                break
        done.append(tree)
        fresh.append(tree)
        if len(fresh) == EVERY and number + 1 < trees:
            rows, fresh = settle(_advance(rows, _grow(fresh, 0.0)), "boost"), []
    return Boosted(_grow(done, 0.0), features, made)


def _advance(rows: DataFrame, trees: Trees) -> DataFrame:
    """rows with the trees' margins added."""
    k = len(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            margin = b.column(2).to_numpy(zero_copy_only=False) + trees.margin(_floats(b, 3, k))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(margin), *(b.column(i) for i in range(3, k))], b.schema.names)

    return rows.mapInArrow(run, rows.schema)
