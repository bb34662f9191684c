"""Helpers that several corpus operators share."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retenta.session import settle

BLANK = r"[\x20\x09-\x0D]+"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back; `release` removes it again.

    The shuffle files of the write go when it ends: nothing reads them once the table is there.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        out = settle(df, f"llm-{name}")
    finally:
        conf.set(_CLEANUP, before)
    out._settled = [f.rsplit("/", 1)[0] for f in out.inputFiles()[:1]]
    return out


def release(*frames: DataFrame) -> None:
    """Delete settled tables that no later plan reads."""
    for df in frames:
        for folder in getattr(df, "_settled", ()):
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; 0 for null."""
    parts = F.split(text, BLANK, -1)
    n = F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - (F.element_at(parts, -1) == "").cast("int")
    return F.when(text.isNull(), 0).otherwise(F.greatest(n, F.lit(0))).cast("long")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(rows: int, each: int) -> int:
    """How many groups of about `each` rows hold `rows` rows; 1 at least."""
    return max(1, math.ceil(rows / each))


def sample_share(have: int, want: int) -> float:
    return min(1.0, want / max(1, have))


def sampled(key: Column, share: Column | float, seed: int) -> Column:
    """True for a pseudorandom share of the keys, the same ones on every run."""
    u = (F.xxhash64(key, F.lit(seed)).bitwiseAND((1 << 52) - 1)).cast("double") / float(1 << 52)
    return u < share


def valid_vectors(df: DataFrame, vec: str = "embedding") -> Column:
    """Condition: a vector without null or non-finite components, not zero, not empty."""
    v = F.col(vec)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def merge_labels(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label that each row and column of a bipartite link mask can reach."""
    top = np.iinfo(np.int64).max
    left, right = left.copy(), right.copy()
    while True:
        new_right = np.minimum(right, np.where(mask, left[:, None], top).min(axis=0, initial=top))
        new_left = np.minimum(left, np.where(mask, new_right[None, :], top).min(axis=1, initial=top))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right
