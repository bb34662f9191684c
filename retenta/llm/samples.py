"""All labelled documents, dealt to shards; tasks fit a model on each shard, and the models are averaged.

A text is shuffled once, to its shard, and only if a bitmap of the labelled ids
lets its id pass.  Labels meet ids first and go to the same shards, so the plan
is the same at every size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from retenta.llm.common import chunks, release, remainder, table

ROWS = 5000         # rows of a shard, about
CHARS = 16_000_000  # characters of a shard, about, unless one text has more
PAGE = 1 << 15      # bits of a row of the bitmap
BITS = 8            # bits for each labelled id: one unlabelled row in nine passes the bitmap, and is dropped in its shard
PAGES = 1 << 12     # rows of the bitmap at most (16 MB); beyond, more unlabelled rows pass


@dataclass
class Deal:
    rows: DataFrame      # (doc_id, shard, place, label, and the text or what `encode` made of it): a partition is a shard, in order of place
    shards: int
    prior: float         # share of label 1 among all labelled ids that may be learned from
    share: float | None  # and among the rows
    held: tuple[DataFrame, ...]

    def release(self) -> None:
        """Delete the tables that `rows` reads."""
        release(*self.held)


def _bitmap(one: DataFrame, n: int, seed: int) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Pages of a bitmap of hashed ids, and a filter that no row with such an id fails."""
    pages = min(PAGES, chunks(BITS * n, PAGE))
    bit = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed + 2)), F.lit(pages * PAGE))
    page, at = F.shiftright(bit, 15).alias("page"), bit.bitwiseAND(PAGE - 1)
    bitmap = table(one.groupBy(page).agg(F.bitmap_construct_agg(at).alias("bits")), "bitmap")

    def passing(rows: DataFrame) -> DataFrame:
        byte = F.conv(F.hex(F.substring("bits", (F.shiftright(at, 3) + 1).cast("int"), 1)), 16, 10).cast("long")
        found = rows.withColumn("page", page).join(F.broadcast(bitmap), "page")
        return found.where(F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1).select(rows.columns)

    return bitmap, passing


def deal(docs: DataFrame, labels: DataFrame, column: str, encode: Callable[[DataFrame], DataFrame] | None = None, seed: int = 42) -> Deal:
    """Every row that may be learned from, with its label, in its shard.

    Rows whose crc32(doc_id as text) modulo 5 is 0 are left out, and so are
    null ids, labels and texts.  A label's repeated id counts once, with its
    largest label; a document's repeated rows stay.  `shard` and `place` (the
    order in a shard) follow from id and text; `encode` gets rows (doc_id,
    shard, place, text), some of them without a label, and keeps the first three.
    """
    usable = labels.where(F.col(column).isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
    one = table(usable.groupBy("doc_id").agg(F.max((F.col(column) > 0).cast("int")).alias("label")), "labels")
    have = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bitmap, passing = _bitmap(one, sum(have.values()), seed)

    def hashed(at: int) -> Column:
        return F.xxhash64("doc_id", "text", F.lit(at))

    mine = passing(docs.select("doc_id", "text").where(F.col("text").isNotNull() & (remainder(F.col("doc_id"), 5) != 0)))
    ids = mine.select("doc_id", hashed(seed + 1).alias("draw"), hashed(seed).alias("place"), F.length("text").cast("long").alias("chars"))
    marks = table(ids.join(one, "doc_id"), "marks")
    size = marks.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"), F.avg("label").alias("share")).first()
    shards = max(chunks(size["rows"], ROWS), chunks(size["chars"], CHARS))

    def shard(draw: Column) -> Column:
        return F.pmod(draw, F.lit(shards)).cast("int").alias("shard")

    rows = mine.select("doc_id", shard(hashed(seed + 1)), hashed(seed).alias("place"), "text")
    rows = encode(rows) if encode else rows
    known = marks.select("doc_id", shard(F.col("draw")), "place", "label").distinct()
    both = rows.withColumn("mark", F.lit(False)).unionByName(known.withColumn("mark", F.lit(True)), allowMissingColumns=True)
    # a window inside a shard's partition: the label travels, not the text
    met = both.repartitionById(shards, F.col("shard")).withColumn("label", F.max("label").over(W.partitionBy("shard", "place", "doc_id")))
    met = met.where(~F.col("mark") & F.col("label").isNotNull()).drop("mark")
    return Deal(met, shards, have.get(1, 0) / max(1, sum(have.values())), size["share"], (one, bitmap, marks))


def labelled(docs: DataFrame, labels: DataFrame, column: str, encode: Callable[[DataFrame], DataFrame] | None = None,
             seed: int = 42) -> tuple[DataFrame, int, float]:
    """The rows of `deal`, written (one file a shard) and read back, the number of shards, and the prior."""
    dealt = deal(docs, labels, column, encode, seed)
    met = table(dealt.rows, f"{column}-rows")
    dealt.release()
    return met, dealt.shards, dealt.prior
