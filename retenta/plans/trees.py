"""Tree ensembles as one table of nodes, their margins and their exact attributions.

The attributions are those of the path-dependent game: a coalition's value is
the tree's answer when features outside it go both ways, by the training rows
below each child.  A leaf is then a box with one interval per feature of its
path, and for each of these features the share of rows that its splits let
through.  With t in [0, 1] the product over the features of t * inside +
(1 - t) * share, integrated over t without a feature's own factor, is that
feature's Shapley weight sum: the factors' degree is known, so a Gauss-Legendre
rule of half as many points is exact, and no subset is ever enumerated.
Pairs leave out two factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
from pyspark.ml import Model
from pyspark.sql import SparkSession, functions as F

from retenta.session import work_folder

CELLS = 1 << 21  # numbers held at once per array while rows are explained
TABLED = 4       # features of a leaf up to which its answers are looked up


@dataclass
class Trees:
    """Nodes of all trees: a row goes left where its feature's value is at most the threshold, else (also without a value) right.

    feature is -1 at leaves; left and right are node numbers; the margin of a
    row is base plus the values of its leaves; cover is the weight of the
    training rows at a node.
    """

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    base: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Margins of the rows of x (one column a feature), all trees at once."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return self.base + self.value[at].sum(axis=1)
            low = x[rows, np.maximum(feature, 0)] <= self.threshold[at]
            at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)

    def visits(self, x: np.ndarray) -> np.ndarray:
        """How many rows of x pass each node."""
        total = np.zeros(len(self.feature), np.int64)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.broadcast_to(np.arange(len(x))[:, None], at.shape)
        at, rows = at.ravel(), rows.ravel()
        while len(at):
            total += np.bincount(at, minlength=len(total))
            inner = self.feature[at] >= 0
            at, rows = at[inner], rows[inner]
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return total

    def with_cover(self, cover: np.ndarray) -> "Trees":
        """The same trees with other covers; a side without rows counts as the smallest share that keeps its parent's sum apart from zero."""
        inner = self.feature >= 0
        cover = np.array(cover, np.float64)
        for node in self.roots.tolist():
            todo = [(node, max(cover[node], 1.0))]
            while todo:
                at, c = todo.pop()
                cover[at] = c
                if inner[at]:
                    a, b = max(cover[self.left[at]], 1e-9 * c), max(cover[self.right[at]], 1e-9 * c)
                    todo += [(int(self.left[at]), c * a / (a + b)), (int(self.right[at]), c * b / (a + b))]
        return Trees(self.roots, self.feature, self.threshold, self.left, self.right, self.value, cover, self.base)

    def cuts(self, features: int) -> list[np.ndarray]:
        """Each feature's distinct thresholds, ascending: rows between the same cuts of every feature take the same ways."""
        return [np.unique(self.threshold[self.feature == f]) for f in range(features)]

    @cached_property
    def boxes(self) -> dict[int, tuple[np.ndarray, ...]]:
        """Leaves by the number of features on their path: (feature, low, high, share) arrays of leaves x features, and values."""
        found: dict[int, list] = {}
        todo = [(int(r), {}) for r in self.roots]
        while todo:
            node, path = todo.pop()
            f = int(self.feature[node])
            if f < 0:
                found.setdefault(len(path), []).append((sorted(path), [path[k] for k in sorted(path)], self.value[node]))
                continue
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            cut, cover = self.threshold[node], self.cover[node]
            for child, span in ((self.left[node], (low, min(high, cut))), (self.right[node], (max(low, cut), high))):
                todo.append((int(child), {**path, f: (*span, share * self.cover[child] / cover)}))
        out = {}
        for m, leaves in found.items():
            leaves.sort(key=lambda leaf: leaf[0])
            spans = np.array([s for _, s, _ in leaves], np.float64).reshape(len(leaves), m, 3)
            out[m] = (np.array([k for k, _, _ in leaves], np.int64).reshape(len(leaves), m), spans[:, :, 0], spans[:, :, 1], spans[:, :, 2],
                      np.array([v for _, _, v in leaves]))
        return out

    @cached_property
    def expectation(self) -> float:
        """The margin of no feature at all: what a row's attributions add to, up to its own margin."""
        return self.base + float(sum((b[4] * b[3].prod(axis=1)).sum() for b in self.boxes.values()))

    def _pieces(self, x: np.ndarray, most: int, fewest: int = 1):
        """(rows, features, inside, share, value, leaves) of pieces that fit CELLS, of leaves with fewest..most features."""
        for m, (feature, low, high, share, value) in self.boxes.items():
            if not fewest <= m <= most:
                continue
            size = m * (m // 2 + 1)
            leaves = max(1, min(len(value), CELLS // size))
            each = max(1, CELLS // (leaves * size))
            for b in range(0, len(value), leaves):
                own = slice(b, b + leaves)
                open_end = np.isposinf(high[own])
                for a in range(0, len(x), each):
                    rows = slice(a, a + each)
                    inside = []
                    for k in range(m):
                        v = x[rows][:, feature[own, k]]
                        inside.append(~(v <= low[own, k]) & ((v <= high[own, k]) | open_end[:, k]))
                    yield rows, feature[own], inside, share[own], value[own], own

    def _tables(self, pairs: bool) -> dict[int, list[np.ndarray]]:
        """By the number of features of a leaf, up to TABLED: what it adds to each (or each pair), leaves x patterns of features inside."""
        out = {}
        for m, (_, _, _, share, value) in self.boxes.items():
            if 1 <= m <= TABLED:
                bits = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(np.float64)
                parts = (_pair_parts if pairs else _parts)(np.broadcast_to(bits[:, None, :], (1 << m, len(value), m)), share, value)
                out[m] = [part.T.ravel() for part in parts]
        return out

    @cached_property
    def single_tables(self) -> dict[int, list[np.ndarray]]:
        return self._tables(False)

    @cached_property
    def pair_tables(self) -> dict[int, list[np.ndarray]]:
        return self._tables(True)

    def _summed(self, x: np.ndarray, size: int, pairs: bool, place) -> np.ndarray:
        """Sums over all leaves of each part of theirs; place(features, number of the part) gives the column it goes to.

        A leaf's parts depend on a row only by which of its features are inside,
        so leaves of few features look them up.
        """
        out = np.zeros((len(x), size))
        tables = self.pair_tables if pairs else self.single_tables
        for rows, feature, inside, _, value, own in self._pieces(x, TABLED):
            m = feature.shape[1]
            at = np.broadcast_to(np.arange(own.start, own.start + len(value)) << m, inside[0].shape).copy()
            for k, part in enumerate(inside):
                at += part.astype(np.int64) << k
            for k, table in enumerate(tables[m]):
                _add(out[rows], table[at], place(feature, k))
        for rows, feature, inside, share, value, _ in self._pieces(x, len(self.feature), TABLED + 1):
            parts = (_pair_parts if pairs else _parts)(np.stack(inside, axis=2).astype(np.float64), share, value)
            for k, part in enumerate(parts):
                _add(out[rows], part, place(feature, k))
        return out

    def attributions(self, x: np.ndarray, features: int) -> np.ndarray:
        """Exact Shapley values, rows x features; a row's values add up to its margin less the expectation."""
        return self._summed(x, features, False, lambda feature, k: feature[:, k])

    def interactions(self, x: np.ndarray, features: int) -> np.ndarray:
        """Exact interaction values, rows x features x features: symmetric, a pair's effect in halves, a row's sums are its attributions."""
        def place(feature: np.ndarray, k: int) -> np.ndarray:
            i, j = list(combinations(range(feature.shape[1]), 2))[k]
            return feature[:, i] * features + feature[:, j]

        out = self._summed(x, features * features, True, place).reshape(len(x), features, features)
        out += out.transpose(0, 2, 1).copy()
        out[:, np.arange(features), np.arange(features)] = self.attributions(x, features) - out.sum(axis=2)
        return out


def _factors(inside: np.ndarray, share: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """inside - share, the factors over t, and their weighted product, for rows x leaves x features."""
    t, w = np.polynomial.legendre.leggauss(share.shape[1] // 2 + 1)
    t, w = (t + 1) / 2, w / 2
    factor = inside[..., None] * t + share[..., None] * (1 - t)
    return inside - share, factor, factor.prod(axis=2) * w * value[:, None]


def _parts(inside: np.ndarray, share: np.ndarray, value: np.ndarray) -> Iterator[np.ndarray]:
    """What each leaf adds to each of its features, rows x leaves."""
    gain, factor, product = _factors(inside, share, value)
    for i in range(share.shape[1]):
        yield gain[:, :, i] * (product / factor[:, :, i]).sum(axis=2)


def _pair_parts(inside: np.ndarray, share: np.ndarray, value: np.ndarray) -> Iterator[np.ndarray]:
    """Half of what each leaf adds to each pair of its features, rows x leaves."""
    gain, factor, product = _factors(inside, share, value)
    for i, j in combinations(range(share.shape[1]), 2):
        yield 0.5 * gain[:, :, i] * gain[:, :, j] * (product / (factor[:, :, i] * factor[:, :, j])).sum(axis=2)


def _add(out: np.ndarray, part: np.ndarray, place: np.ndarray) -> None:
    """out[:, place[k]] += part[:, k] for every k, places repeated."""
    if (np.diff(place) < 0).any():
        order = np.argsort(place, kind="stable")
        part, place = part[:, order], place[order]
    starts = np.flatnonzero(np.concatenate([[True], np.diff(place) > 0]))
    out[:, place[starts]] += np.add.reduceat(part, starts, axis=1)


def from_ml(model: Model, spark: SparkSession) -> Trees:
    """The nodes of a fitted Spark ML forest or boosted classifier, read from its saved form.

    The margin of a forest is the probability of class 1, that of boosted trees
    its log odds.  Only the model reaches the driver; its size does not grow
    with the data.
    """
    import uuid

    path = f"{work_folder(spark)}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    stats = F.col("nodeData.impurityStats")
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction", stats.alias("stats"), "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"), F.col("nodeData.split.numCategories").alias("categories"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).orderBy("tree", "id").collect()
    if any(r["leftChild"] >= 0 and r["categories"] >= 0 for r in rows):
        raise ValueError("categorical splits have no threshold: index categories as numbers or one-hot columns")
    weights = list(model.treeWeights)
    forest = "RandomForest" in type(model).__name__
    number = {(r["tree"], r["id"]): i for i, r in enumerate(rows)}

    def value(r) -> float:
        return r["stats"][1] / sum(r["stats"]) / len(weights) if forest else 2.0 * weights[r["tree"]] * r["prediction"]

    inner = [r["leftChild"] >= 0 for r in rows]
    return Trees(
        np.array([i for (_, node), i in number.items() if node == 0]),
        np.array([r["feature"] if k else -1 for r, k in zip(rows, inner)]), np.array([r["threshold"] if k else 0.0 for r, k in zip(rows, inner)]),
        np.array([number[r["tree"], r["leftChild"]] if k else -1 for r, k in zip(rows, inner)]),
        np.array([number[r["tree"], r["rightChild"]] if k else -1 for r, k in zip(rows, inner)]),
        np.array([0.0 if k else value(r) for r, k in zip(rows, inner)]),
        np.array([sum(r["stats"]) if forest else r["stats"][0] for r in rows], np.float64))
