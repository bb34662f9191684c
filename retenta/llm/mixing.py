"""Mixing sources to target weights, in blocks of a fixed number of words.

The documents of a source form one word stream, cut into blocks of equal
length.  A source's target gives its number of slots.  Slots fall on output
shards as a multinomial draw, made by halving the range of shards down a tree:
every shard's counts and first slots follow from the seed alone, so shards are
drawn in parallel and the totals are exact.  Slot c of a source is block
permute(c mod blocks) of pass c div blocks, a keyed permutation of the source's
block numbers; slots and blocks then meet in a join by block number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from retenta.llm.common import BLANK, chunks, table, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK = 64           # words per block
SHARD_SLOTS = 16384  # slots per output shard, on average
BUCKET = 20_000      # documents per bucket of a source's stream
SEED = 42


def targets(sizes: np.ndarray, weights: np.ndarray, share: float = SHARE, most: float = MOST) -> np.ndarray:
    """Words wanted from each source: share * all words by weight, none above most * its size."""
    sizes = np.asarray(sizes, dtype=np.float64)
    out, free = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    left = share * sizes.sum()
    while free.any():
        part = left * weights[free] / weights[free].sum()
        over = part > most * sizes[free]
        if not over.any():
            out[free] = part
            break
        which = np.flatnonzero(free)[over]
        out[which] = most * sizes[which]
        left -= out[which].sum()
        free[which] = False
    return out


def shard_slots(slots: np.ndarray, shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, number of slots) of one output shard, for every source."""
    first, count = np.zeros_like(slots), slots.copy()
    lo, hi = 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        drawn = np.random.default_rng([seed, lo, hi]).binomial(count, (mid - lo) / (hi - lo))
        if shard < mid:
            count, hi = drawn, mid
        else:
            first, count, lo = first + drawn, count - drawn, mid
    return first, count


def permute(index: np.ndarray, n: int, key: tuple[int, ...]) -> np.ndarray:
    """A keyed permutation of range(n), at the given indexes: four Feistel rounds, walked back into range."""
    half = max(1, (max(2, n) - 1).bit_length() + 1) // 2 + 1
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(list(key)).integers(1, 1 << 62, 4, dtype=np.uint64)
    x = index.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def _sources(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, block: int) -> pd.DataFrame:
    """One row per source in mixing order; the number of sources is that of a configuration, not of the data."""
    rows = docs.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))
    size = np.array([r["size"] for r in rows], dtype=np.int64)
    weight = np.array([weights[i % len(weights)] for i in range(len(rows))], dtype=np.float64)
    target = targets(size, weight, share, most)
    blocks = -(-size // block)
    slots = np.minimum(np.rint(target * blocks / np.maximum(size, 1)), most * blocks).astype(np.int64)
    return pd.DataFrame({"s": range(len(rows)), "source": [r["source"] for r in rows], "source_size": size, "target": target,
                         "blocks": blocks, "slots": slots})


def _placed(docs: DataFrame, extra: list[str], weights, share: float, most: float, block: int):
    """Every row with its source number and the place of its first word in the source's stream; and the sources."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *extra)
    sized = table(sized, "sizes")
    known = _sources(sized, weights, share, most, block)
    keys = sized.sparkSession.createDataFrame([(int(s), src) for s, src in zip(known["s"], known["source"])], "s int, src string")
    buckets = chunks(sized.count(), BUCKET)
    rows = sized.join(keys, F.col("source").eqNullSafe(F.col("src"))).drop("src").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("s", "bucket").orderBy("doc_id", "size", *extra).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
    above = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("s", "bucket", F.coalesce(F.sum("words").over(above), F.lit(0)).alias("offset"))
    local = rows.withColumn("local", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = local.join(offsets, ["s", "bucket"]).select("doc_id", "s", "size", *extra, (F.col("offset") + F.col("local")).alias("start"))
    return table(placed, "placed"), known


def _slots(spark, known: pd.DataFrame, seed: int) -> DataFrame:
    """(shard, s, block, pass): the block that each slot of the mix takes."""
    slots, blocks = known["slots"].to_numpy(), known["blocks"].to_numpy()
    shards = chunks(int(slots.sum()), SHARD_SLOTS)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["id"]:
                first, count = shard_slots(slots, shards, int(shard), seed)
                for s in np.flatnonzero(count):
                    c = np.arange(first[s], first[s] + count[s])
                    turn = c // blocks[s]
                    block = np.empty_like(c)
                    for e in np.unique(turn):
                        block[turn == e] = permute(c[turn == e] % blocks[s], int(blocks[s]), (seed, int(s), int(e)))
                    yield pd.DataFrame({"shard": shard, "s": s, "block": block, "pass": turn})

    # the planner takes the result to be as small as the range: joins with it need a hint, or it would be broadcast
    return spark.range(0, shards, 1, min(shards, 4 * spark.sparkContext.defaultParallelism)).mapInPandas(
        draw, "shard long, s int, block long, pass long")


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """Documents cut at the block borders: from and to are word places in the document."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = placed.where(F.col("size") > 0).withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("block") * block - F.col("start"), F.lit(0))
    end = F.least((F.col("block") + 1) * block - F.col("start"), F.col("size"))
    return cut.withColumn("from", begin).withColumn("to", end)


def mix_counts(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken.

    size counts the text's words (null text: 0) and taken the words the mix
    takes of it, repeats counted, at most `most` times the size.  Sources go by
    code point, null last, with the weights repeating.  Null and repeated ids
    and repeated rows stay rows of their own; an empty table gives an empty
    one; other columns are ignored.
    """
    placed, known = _placed(docs, [], weights, share, most, block)
    spark = docs.sparkSession
    times = _slots(spark, known, seed).groupBy("s", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = _pieces(placed, block).join(times.hint("merge"), ["s", "block"], "left").groupBy("doc_id", "s", "start", "size").agg(
        F.sum(F.coalesce("times", F.lit(0)) * (F.col("to") - F.col("from"))).alias("taken"))
    none = placed.where(F.col("size") == 0).select("doc_id", "s", "start", "size", F.lit(0).cast("long").alias("taken"))
    facts = spark.createDataFrame(known[["s", "source_size", "target"]].to_dict("records"), "s int, source_size long, target double")
    return taken.unionByName(none).join(facts, "s").select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of documents: one row per document and pass that takes words of it.

    A text taken whole stays as it is; else its taken blocks follow each other,
    words joined by a space.  n_chars is counted anew.  Texts without words are
    not part of a mix.
    """
    keyed = docs.select("doc_id", "text", "lang", "source", "n_chars", F.xxhash64("text", "lang", "n_chars").alias("mix_key"))
    placed, known = _placed(keyed, ["mix_key"], weights, share, most, block)
    drawn = _pieces(placed, block).join(_slots(docs.sparkSession, known, seed).hint("merge"), ["s", "block"])
    runs = drawn.groupBy("doc_id", "mix_key", "s", "start", "size", "pass").agg(
        F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"), F.sum(F.col("to") - F.col("from")).alias("words"))
    names = docs.sparkSession.createDataFrame([(int(s), src) for s, src in zip(known["s"], known["source"])], "s int, mix_source string")
    runs = runs.join(names, "s").select(F.col("doc_id").alias("mix_doc"), F.col("mix_key").alias("mix_row"), "mix_source", "size", "runs", "words")
    same = F.col("doc_id").eqNullSafe(F.col("mix_doc")) & (F.col("mix_key") == F.col("mix_row")) & F.col("source").eqNullSafe(F.col("mix_source"))
    joined = keyed.dropDuplicates(["doc_id", "mix_key", "source"]).join(runs, same)
    return joined.select("doc_id", _taken_text(F.col("text")).alias("text"), "lang", "source").select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def _taken_text(text: Column) -> Column:
    """The words of `runs`, joined by a blank.

    The words enter as the one element of an outer array: the text is split
    once, not once per run.
    """
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    pick = F.transform(F.array(words), lambda all_words: F.flatten(F.transform(
        "runs", lambda r: F.slice(all_words, (r["from"] + 1).cast("int"), (r["to"] - r["from"]).cast("int")))))
    return F.when(F.col("words") == F.col("size"), text).otherwise(F.array_join(pick[0], " "))
