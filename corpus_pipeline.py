"""A corpus pipeline of five operators; every stage's result is written and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from retenta.llm import langid, linededup, mixing, packing, simhash
from retenta.llm.common import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the filters know; texts without one go."""
    return langid.reject_unknown(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that recur across them, short ones included."""
    cleaned = linededup.drop_lines(docs.select(*COLUMNS), short=True)
    return cleaned.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.keep_one(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the shares that their sources' weights ask for; a document can come twice or in part."""
    return mixing.mix_documents(docs.select(*COLUMNS))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mix", source_mix),
    ("sequence_packing", sequence_packing),
]
ORACLE_SQL = None  # fingerprints and token ids are beyond SQL; tests/llm compares with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), name)
    return docs
