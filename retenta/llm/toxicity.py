"""Toxicity by a small convolutional text classifier, trained in numpy by tasks.

Every labelled row is learned from: four fifths train, dealt to shards.  In
each round every shard goes on from the common network by itself, and the
changes are averaged (an embedding's over the shards that changed it).

Words are hashed to buckets, and buckets met in several training texts have
embeddings (all others share a zero row, so a long text's rare words cannot add
up to noise).  Filters of widths 1 to 3 slide over a text, the largest answer of each filter over the whole text is kept, and a linear
layer with a logistic function gives the score.  Only the words under a
filter's largest answer carry a gradient, so a training step is cheap however
long the text.  One threshold per language, of the language filters' own
prediction from the text, is calibrated on the fifth of the labelled rows set
aside from training; the score is shifted so that each threshold lies at 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retenta.llm import langid
from retenta.llm.common import release, remainder, table
from retenta.llm.samples import labelled
from retenta.plans.order import running_totals

BUCKETS = 1 << 22
LEAST_DOCS = 5      # training texts that a bucket must be met in to get an embedding,
LEAST_SHARE = 1e-3  # and their share of all training texts: bounds the network, whatever the table
DIM = 16
FILTERS = 12
WIDTHS = (1, 2, 3)
ROUNDS = 6
LEAST_STEPS = 1000  # training steps of a shard at least
UNIT = float(1 << 32)  # of the whole numbers that changes are averaged in
START = 0.002       # spread of the first embeddings: words that teach nothing stay near zero
BATCH = 16          # texts per training step
RATE = 0.05
ASIDE = 5           # every fifth labelled id calibrates thresholds
LEAST_ROWS = 20     # rows of each label that a language needs for a threshold of its own
CHUNK = 100_000     # words scored at once, unless one text has more
MEMO = 1 << 19
_EDGES = b".,;:!?()[]\"'"


class Words:
    """Numbers of a text's words: buckets, or embedding rows where those are given; remembers recent words."""

    def __init__(self, rows: dict[int, int] | None = None) -> None:
        self.rows, self.memo = rows, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().encode("utf-8", "surrogatepass").split()
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo, out = self.memo, np.empty(len(words), np.int32)
        for i, w in enumerate(words):
            h = memo.get(w)
            if h is None:
                h = zlib.crc32(w.strip(_EDGES)) % BUCKETS
                h = memo[w] = h if self.rows is None else self.rows.get(h, 0)
            out[i] = h
        return out


@dataclass
class Network:
    rows: dict[int, int]              # embedding row of each bucket that has one
    table: np.ndarray                 # (rows, dim); row 0 is zero, for padding and all other words
    filters: list[np.ndarray]         # per width: (width, dim, filters)
    biases: np.ndarray                # (widths, filters)
    weights: np.ndarray               # (widths * filters)
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)  # logits, by language; "" for all others

    @classmethod
    def start(cls, buckets: list[int], seed: int = 42) -> "Network":
        rng = np.random.default_rng(seed)
        table = rng.normal(0, START, (len(buckets) + 1, DIM)).astype(np.float32)
        table[0] = 0
        filters = [rng.normal(0, 1 / np.sqrt(w * DIM), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        return cls({b: i + 1 for i, b in enumerate(buckets)}, table, filters, np.zeros((len(WIDTHS), FILTERS), np.float32),
                   rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)

    def project(self) -> list[list[np.ndarray]]:
        """Per width and place: what each bucket adds to each filter."""
        return [[self.table @ f[j] for j in range(len(f))] for f in self.filters]

    def logits(self, texts: list[np.ndarray], projected: list[list[np.ndarray]]) -> np.ndarray:
        ids, begin = _flat(texts)
        pooled = np.concatenate(_pool(texts, ids, begin, projected)[0], axis=1)
        return np.maximum(0, pooled + self.biases.ravel()) @ self.weights + self.bias


def _flat(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another, each followed by padding; an empty text is one padding word."""
    pad = np.zeros(len(WIDTHS), np.int32)
    parts, begin, at = [], [], 0
    for t in texts:
        t = t if len(t) else pad[:1]
        begin.append(at)
        parts += [t, pad]
        at += len(t) + len(pad)
    return np.concatenate(parts), np.array(begin)


def _pool(texts: list[np.ndarray], rows: np.ndarray, begin: np.ndarray, projected) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Largest answer of every filter per text, and the answers at every place."""
    bounds = np.stack([begin, begin + [max(1, len(t)) for t in texts]], axis=1).ravel()
    pooled, answers = [], []
    for p in projected:
        a = p[0][rows]
        for j in range(1, len(p)):
            a[:-j] += p[j][rows[j:]]
        pooled.append(np.maximum.reduceat(a, bounds, axis=0)[::2])
        answers.append(a)
    return pooled, answers


class Squares:
    """Sums of squared gradients: one number a bucket, and one for each other parameter."""

    def __init__(self, net: Network) -> None:
        self.table = np.full(len(net.table), 1e-2, np.float32)
        self.dense = np.full(_dense(net).shape, 1e-2, np.float32)


def _dense(net: Network) -> np.ndarray:
    return np.concatenate([*(f.ravel() for f in net.filters), net.biases.ravel(), net.weights, [net.bias]]).astype(np.float32)


def _set_dense(net: Network, values: np.ndarray) -> None:
    at = 0
    for k, f in enumerate(net.filters):
        net.filters[k] = values[at:at + f.size].reshape(f.shape).astype(np.float32)
        at += f.size
    net.biases = values[at:at + net.biases.size].reshape(net.biases.shape).astype(np.float32)
    at += net.biases.size
    net.weights = values[at:at + net.weights.size].astype(np.float32)
    net.bias = float(values[-1])


def train(net: Network, squares: Squares, texts: list[np.ndarray], labels: list[int], share: float, passes: int, seed: int = 42) -> None:
    """Adagrad on the logistic loss from the given state, changed in place; texts are embedding rows, `share` is that of label 1."""
    labels = np.asarray(labels, np.float32)
    rng = np.random.default_rng(seed)
    steps = -(-len(texts) // BATCH)
    even = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)).astype(np.float32)
    for _ in range(passes):
        for rows in np.array_split(rng.permutation(len(texts)), max(1, steps)):
            batch = [texts[i] for i in rows]
            if not batch:
                continue
            ids, begin = _flat(batch)
            used, back = np.unique(ids, return_inverse=True)
            e = net.table[used]
            pooled, answers = _pool(batch, back, begin, [[e @ f[j] for j in range(len(f))] for f in net.filters])
            act = np.concatenate(pooled, axis=1) + net.biases.ravel()
            hidden = np.maximum(0, act)
            p = 1 / (1 + np.exp(-np.clip(hidden @ net.weights + net.bias, -30, 30)))
            err = ((p - labels[rows]) * even[rows] / len(rows)).astype(np.float32)
            g_w = hidden.T @ err
            down = (err[:, None] * net.weights) * (act > 0)
            g_e = np.zeros_like(e)
            grads = []
            for k, w in enumerate(WIDTHS):
                part = down[:, k * FILTERS:(k + 1) * FILTERS]
                text, filt = np.nonzero(part)
                grad = np.zeros_like(net.filters[k])
                grads.append(grad)
                if not len(text):
                    continue
                d = part[text, filt]
                where = _places(answers[k], batch, begin)[text, filt]
                for j in range(w):
                    row = back[where + j]
                    real = ids[where + j] != 0
                    np.add.at(grad[j].T, filt, d[:, None] * e[row])
                    np.add.at(g_e, row[real], d[real, None] * net.filters[k][j].T[filt[real]])
            g = np.concatenate([*(x.ravel() for x in grads), down.sum(axis=0), g_w, [err.sum()]])
            squares.dense += g ** 2
            _set_dense(net, _dense(net) - RATE * g / np.sqrt(squares.dense))
            size = (g_e ** 2).mean(axis=1)
            moved = size > 0
            squares.table[used[moved]] += size[moved]
            net.table[used[moved]] -= RATE * g_e[moved] / np.sqrt(squares.table[used[moved], None])


def _places(answers: np.ndarray, texts: list[np.ndarray], begin: np.ndarray) -> np.ndarray:
    return np.stack([b + answers[b:b + max(1, len(t))].argmax(axis=0) for b, t in zip(begin, texts)])


def thresholds(scored: DataFrame, prior: float) -> dict[str, float]:
    """Cuts of (lang, logit, label), of all rows ("") and of each language with LEAST_ROWS of each label.

    A cut makes the fewest errors when a share `prior` of texts has label 1, and
    lies in the middle of the gap around it.  The driver gets a few numbers a language.
    """
    both = scored.withColumn("lang", F.explode(F.array(F.lit(""), "lang")))
    ones = F.sum(F.col("label").cast("long"))
    group = both.groupBy("lang").agg(ones.alias("p"), (F.count(F.lit(1)) - ones).alias("q"), F.max("logit").alias("top"))
    groups = {r["lang"]: r for r in group.collect() if not r["lang"] or min(r["p"], r["q"]) >= LEAST_ROWS}
    if not groups:
        return {}
    kept = both.where(F.col("lang").isin(*groups))
    runs = kept.groupBy("lang", "logit").agg(ones.alias("ones"), (F.count(F.lit(1)) - ones).alias("zeros"))
    upto = running_totals(runs, "logit", {"caught": F.col("ones"), "wrong": F.col("zeros")}, by=["lang"], descending=True)
    totals = scored.sparkSession.createDataFrame(
        [(g, r["p"], prior / max(1, r["p"]), (1 - prior) / max(1, r["q"])) for g, r in groups.items()], "lang string, p long, w1 double, w0 double")
    errors = upto.join(F.broadcast(totals), "lang").withColumn("errors", F.col("w1") * (F.col("p") - F.col("caught")) + F.col("w0") * F.col("wrong"))
    best = errors.groupBy("lang").agg(F.min(F.struct("errors", -F.col("logit"))).alias("b")).select("lang", "b.errors", (-F.col("b.col2")).alias("high"))
    best = {r["lang"]: r for r in best.collect()}
    highs = scored.sparkSession.createDataFrame([(g, r["high"]) for g, r in best.items()], "lang string, high double")
    below = {r["lang"]: r["low"] for r in runs.join(F.broadcast(highs), "lang").where(F.col("logit") < F.col("high")).groupBy("lang").agg(
        F.max("logit").alias("low")).collect()}
    cuts = {}
    for g, r in groups.items():
        if r["p"] * (prior / max(1, r["p"])) <= best[g]["errors"]:
            cuts[g] = r["top"] + 1
        else:
            cuts[g] = (best[g]["high"] + below.get(g, best[g]["high"] - 2)) / 2
    return cuts


def _encode(languages: langid.LanguageFilters):
    """Rows (doc_id, shard, place, lang, words): hashed words, and the predicted language of the rows set aside (null: train)."""

    def encode(rows: DataFrame) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(languages)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = Words()
            for b in batches:
                texts = b.column("text").to_pylist()
                found = [words(t) for t in texts]
                ends = np.cumsum([0, *(len(f) for f in found)])
                lang = [shared.value.predict(t)[0] if a else None for t, a in zip(texts, b.column("aside").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("shard"), b.column("place"), pa.array(lang, pa.string()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *found]), pa.int32()))],
                    ["doc_id", "shard", "place", "lang", "words"])

        aside = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(ASIDE)) == 0
        return rows.select("doc_id", "shard", "place", aside.alias("aside"), "text").mapInArrow(
            run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, shard int, place long, lang string, words array<int>")

    return encode


def _texts(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[i:j] for i, j in zip(ends[:-1], ends[1:])]


def _vocabulary(rows: DataFrame, least: float) -> np.ndarray:
    """Buckets met in at least `least` texts, ascending."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, n = np.unique(np.concatenate([np.empty(0, np.int32), *(np.unique(t) for t in _texts(b.column(0)))]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(n, pa.int64())], ["bucket", "n"])

    met = rows.select("words").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return np.sort(met.where(F.col("n") >= least).select("bucket").toArrow()["bucket"].to_numpy())


def _rows_of(buckets: np.ndarray, texts: list[np.ndarray]) -> list[np.ndarray]:
    """Embedding rows of hashed words."""
    lookup = np.zeros(BUCKETS, np.int32)
    lookup[buckets] = np.arange(1, len(buckets) + 1)
    return [lookup[t] for t in texts]


def _round(rows: DataFrame, net: Network, squares: Squares, buckets: np.ndarray, share: float, passes: int, seed: int) -> None:
    """One round: every shard trains from the common state, whose parameters then move by the mean change.

    A row of changes is an embedding's, with its sum of squares last, or 17
    of the other parameters (negative numbers).  Changes are whole numbers, so their
    sums are the same in any order; the driver gets one network.
    """
    shared = rows.sparkSession.sparkContext.broadcast((net, squares, buckets))
    wide = DIM + 1

    def change(texts: list[np.ndarray], labels: list[int], shard: int) -> pa.RecordBatch:
        start, before, places = shared.value
        own = Network({}, start.table.copy(), [f.copy() for f in start.filters], start.biases.copy(), start.weights.copy(), start.bias)
        sums = Squares(own)
        sums.table, sums.dense = before.table.copy(), before.dense.copy()
        train(own, sums, _rows_of(places, texts), labels, share, passes, seed + 1000 * shard)
        moved = np.flatnonzero(sums.table != before.table)
        lean = np.column_stack([own.table[moved] - start.table[moved], sums.table[moved] - before.table[moved]])
        dense = np.concatenate([_dense(own) - _dense(start), sums.dense - before.dense])
        dense = np.resize(np.append(dense, np.zeros(-len(dense) % wide)), (-(-len(dense) // wide), wide))
        numbers = np.concatenate([moved, -1 - np.arange(len(dense))])
        values = np.rint(np.concatenate([lean, dense]) * UNIT).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), *(pa.array(v) for v in values.T)], ["row", *(f"v{i}" for i in range(wide))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, texts, labels = None, [], []
        for b in batches:
            for shard, label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _texts(b.column(2))):
                if shard != at and texts:
                    yield change(texts, labels, at)
                    texts, labels = [], []
                at = shard
                texts.append(text)
                labels.append(label)
        if texts:
            yield change(texts, labels, at)

    changes = rows.select("shard", "label", "words").mapInArrow(run, "row int, " + ", ".join(f"v{i} long" for i in range(wide)))
    mean = changes.groupBy("row").agg(*[(F.sum(f"v{i}") / F.count(F.lit(1))).alias(f"v{i}") for i in range(wide)]).toArrow()
    shared.destroy()
    number, values = mean["row"].to_numpy(), np.column_stack([mean[f"v{i}"].to_numpy() for i in range(wide)]) / UNIT
    lean = number >= 0
    net.table[number[lean]] += values[lean, :DIM].astype(np.float32)
    squares.table[number[lean]] += values[lean, DIM].astype(np.float32)
    dense = values[~lean][np.argsort(-number[~lean])].ravel()
    if len(dense):
        size = len(squares.dense)
        _set_dense(net, _dense(net) + dense[:size])
        squares.dense += dense[size:2 * size].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, languages: langid.LanguageFilters, column: str = "toxic") -> Network:
    # one file a shard, which every round reads without a shuffle
    rows, shards, prior = labelled(docs, labels, column, _encode(languages))
    learn, aside = rows.where(F.col("lang").isNull()), rows.where(F.col("lang").isNotNull())
    size = learn.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    buckets = _vocabulary(learn, max(LEAST_DOCS, LEAST_SHARE * size["n"]))
    net = Network.start(buckets.tolist())
    squares = Squares(net)
    if size["n"]:
        steps = -(-size["n"] // (shards * BATCH))
        for r in range(ROUNDS):
            _round(learn, net, squares, buckets, size["ones"] / size["n"], max(1, -(-LEAST_STEPS // (steps * ROUNDS))), 42 + r)
    shared = docs.sparkSession.sparkContext.broadcast((net, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, places = shared.value
        projected = model.project()
        for b in batches:
            found = [model.logits([t], projected)[0] for t in _rows_of(places, _texts(b.column(2)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64()), b.column(1)], ["lang", "logit", "label"])

    scored = table(aside.select("lang", "label", "words").mapInArrow(run, "lang string, logit double, label int"), "logits")
    net.thresholds = thresholds(scored, prior)
    release(rows, scored)
    return net


def score(docs: DataFrame, net: Network, languages: langid.LanguageFilters) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null and empty texts score like a text of padding.  With no labelled row
    the untrained network answers.  A null doc_id is not held out.  Repeated
    rows stay; an empty table gives an empty one; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((net, languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, filters = shared.value
        words, projected = Words(model.rows), model.project()
        for b in batches:
            texts = b.column(1).to_pylist()
            logits, held, count = [], [], 0
            for t in texts:
                held.append(words(t))
                count += len(held[-1])
                if count > CHUNK:
                    logits.append(model.logits(held, projected))
                    held, count = [], 0
            if held:
                logits.append(model.logits(held, projected))
            cut = np.array([model.thresholds.get(filters.predict(t)[0], model.thresholds.get("", 0.0)) for t in texts])
            found = 1 / (1 + np.exp(-np.clip((np.concatenate(logits) if logits else np.empty(0)) - cut, -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
