"""Isolation forest: trees grown from small samples on the cluster, rows scored in Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from retenta.operators.transform import _fill
from retenta.params import OutlierParams
from retenta.plans.quantiles import fit_quantiles
from retenta.session import settle

EULER = 0.5772156649015329


def _norm(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + EULER) - 2 * (n - 1) / n


def _grow(x: np.ndarray, depth: int, limit: int, rng: np.random.Generator) -> dict:
    spread = [j for j in range(x.shape[1]) if x[:, j].max() > x[:, j].min()] if len(x) > 1 else []
    if depth >= limit or not spread:
        return {"d": depth + _norm(len(x))}
    j = int(rng.choice(spread))
    cut = float(rng.uniform(x[:, j].min(), x[:, j].max()))
    left = x[:, j] <= cut
    return {"j": j, "c": cut, "l": _grow(x[left], depth + 1, limit, rng), "r": _grow(x[~left], depth + 1, limit, rng)}


def _depths(tree: dict, x: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    if "d" in tree:
        out[rows] += tree["d"]
        return
    left = x[rows, tree["j"]] <= tree["c"]
    if left.any():
        _depths(tree["l"], x, rows[left], out)
    if not left.all():
        _depths(tree["r"], x, rows[~left], out)


def isolation_outliers(df: DataFrame, ident: str, cols: Sequence[str], trees: int = 100, sample: int = 256, seed: int = 42,
                       params: OutlierParams = OutlierParams()) -> DataFrame:
    """Add `anomaly_score` and `is_outlier` (the `contamination` share with the highest scores).

    Every tree sees its own `sample` rows: each (tree, row) pair is drawn by hash
    with a share of about 2 * sample / rows, and a tree keeps the first `sample`
    of its rows by hash.  Trees are tiny and travel to the tasks as text.
    """
    cols = list(cols)
    fill = {c: q[0] for c, q in fit_quantiles(df, cols, [0.5]).items()}
    ready = _fill(df, fill)
    n, steps = df.count(), 1 << 53
    rows = ready.select(ident, *cols)
    # twice the wanted share, so that a tree hardly ever falls short of its sample
    share = min(1.0, 2.0 * sample / max(n, 1))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(
        F.xxhash64(F.lit(seed), t, F.col(ident)), F.lit(steps)) < F.lit(int(share * steps)))
    draws = rows.withColumn("tree", F.explode(drawn))
    draws = draws.withColumn("h", F.xxhash64(F.lit(seed + 2), F.col("tree"), F.col(ident)))

    def build(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["h", ident]).head(sample)
        t = int(g["tree"].iloc[0])
        x = g[cols].to_numpy(float)
        tree = _grow(x, 0, int(np.ceil(np.log2(max(len(x), 2)))), np.random.default_rng(seed + t))
        return pd.DataFrame({"tree": [t], "size": [len(x)], "nodes": [json.dumps(tree)]})

    built = draws.groupBy("tree").applyInPandas(build, "tree int, size int, nodes string").orderBy("tree").collect()
    forest = df.sparkSession.sparkContext.broadcast([json.loads(r["nodes"]) for r in built])
    scale = _norm(max(r["size"] for r in built))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b[[f"_x_{c}" for c in cols]].to_numpy(float)
            depth = np.zeros(len(x))
            for tree in forest.value:
                _depths(tree, x, np.arange(len(x)), depth)
            b = b.drop(columns=[f"_x_{c}" for c in cols])
            b["anomaly_score"] = 2.0 ** (-depth / len(forest.value) / scale)
            yield b

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", anomaly_score double"
    wide = df.withColumns({f"_x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(fill[c])) for c in cols})
    # settled, so that the quantile passes and the result do not score again
    scored = settle(wide.mapInPandas(score, schema), "isolation-scores")
    cut = fit_quantiles(scored, ["anomaly_score"], [1 - params.contamination])["anomaly_score"][0]
    return scored.withColumn("is_outlier", F.col("anomaly_score") > F.lit(cut))
