"""Quality by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Tokens are words and runs of other signs.  A text is the counts of its hashed
1- and 2-grams, scaled to length one; a 2-gram of one word twice has a bucket
of its own, as its words are seldom met again.  The score is a sparse dot
product through the logistic function.  Every labelled row is learned from:
each shard of them trains a regression in a task, and a weight is its mean over
the shards that met its bucket.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retenta.llm.common import remainder
from retenta.llm.samples import deal

BUCKETS = 1 << 18
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
UNIT = 1 << 32      # of the whole numbers that weights are averaged in
KEEP = 0.3
MEMO = 1 << 19      # words whose hash a task remembers
_TOKEN = re.compile(r"\w+|[^\w\s]+")


class Features:
    """Sparse features of texts; remembers the hashes of recent words."""

    def __init__(self, buckets: int = BUCKETS) -> None:
        self.buckets, self.memo = buckets, {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        tokens = _TOKEN.findall(text or "")
        if not tokens:
            return np.empty(0, np.int64), np.empty(0)
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo, ids = self.memo, np.empty(len(tokens), np.uint64)
        for i, t in enumerate(tokens):
            h = memo.get(t)
            if h is None:
                h = memo[t] = zlib.crc32(t.lower().encode("utf-8", "surrogatepass"))
            ids[i] = h
        first, second = ids[:-1], ids[1:]
        pair = ((first * np.uint64(0x9E3779B1) + second) * np.uint64(0x85EBCA77C2B2AE63)) >> np.uint64(24)
        pair[first == second] = 1
        place, n = np.unique(np.concatenate([ids, pair]) % np.uint64(self.buckets), return_counts=True)
        return place.astype(np.int64), n / np.sqrt((n * n).sum())


@dataclass
class Logistic:
    weights: np.ndarray
    bias: float

    def score(self, place: np.ndarray, value: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.bias + self.weights[place] @ value, -35, 35))))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], buckets: int = BUCKETS, epochs: int = EPOCHS,
          seed: int = 42) -> tuple[Logistic, np.ndarray]:
    """FTRL-proximal over the rows in a seeded order; also the buckets that a row had."""
    z, n, w = np.zeros(buckets), np.zeros(buckets), np.zeros(buckets)
    bz = bn = bias = 0.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            place, value = rows[i]
            own = z[place]
            w[place] = np.where(np.abs(own) <= L1, 0.0, (np.sign(own) * L1 - own) / ((BETA + np.sqrt(n[place])) / ALPHA + L2))
            bias = -bz / ((BETA + np.sqrt(bn)) / ALPHA)
            p = 1.0 / (1.0 + np.exp(-np.clip(bias + w[place] @ value, -35, 35)))
            g = (p - labels[i]) * value
            z[place] += g - (np.sqrt(n[place] + g * g) - np.sqrt(n[place])) / ALPHA * w[place]
            n[place] += g * g
            gb = p - labels[i]
            bz += gb - (np.sqrt(bn + gb * gb) - np.sqrt(bn)) / ALPHA * bias
            bn += gb * gb
    w = np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return Logistic(w, float(bias)), np.flatnonzero(n)


def _fit_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each shard's model: (place, weight) for its buckets and, at place -1, the bias; weights in units of 1 / UNIT.

    Rows are (shard, label, text), a shard's rows one after another; only their features are kept.
    """
    def fitted() -> pa.RecordBatch:
        model, met = train(rows, labels)
        return pa.RecordBatch.from_arrays([pa.array(np.append(met, -1), pa.int64()),
                                           pa.array(np.rint(np.append(model.weights[met], model.bias) * UNIT).astype(np.int64))], ["place", "weight"])

    features, at, rows, labels = Features(), None, [], []
    for b in batches:
        for shard, label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            if shard != at and rows:
                yield fitted()
                rows, labels = [], []
            at = shard
            rows.append(features(text.as_py()))
            labels.append(label)
    if rows:
        yield fitted()


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality") -> Logistic:
    """Mean of the shards' regressions; the bias is moved from the training rows' share of label 1 to that of all labelled ids."""
    dealt = deal(docs, labels, column)
    models = dealt.rows.select("shard", "label", "text").mapInArrow(_fit_shards, "place long, weight long")
    # sums of whole numbers: the same in any order.  At most BUCKETS + 1 rows come back
    mean = models.groupBy("place").agg((F.sum("weight") / F.count(F.lit(1)) / UNIT).alias("weight")).toArrow()
    dealt.release()
    prior, share = dealt.prior, dealt.share
    place, weight = mean["place"].to_numpy(), mean["weight"].to_numpy()
    weights = np.zeros(BUCKETS, np.float32)
    weights[place[place >= 0]] = weight[place >= 0]
    bias = float(weight[place < 0].sum())
    if share is not None and 0 < share < 1 and 0 < prior < 1:
        bias += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Logistic(weights, float(bias))


def score(docs: DataFrame, model: Logistic, keep: float = KEEP) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null and empty texts have no features and get the bias's score.  With no
    labelled row every score is 0.5.  A null doc_id is not held out.  Repeated
    rows stay; an empty table gives an empty one; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(len(shared.value.weights))
        for b in batches:
            found = [shared.value.score(*features(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= keep).cast("int").alias("predicted"))
