"""Registered queries of the corpus operators, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from retenta.llm import collision, egojoin, html, langid, license, linededup, merkle, mixing, packing, periodic, quality, simhash, toxicity


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_read(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return egojoin.similarity_join(_read(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    languages = langid.fit(langid.train_rows(docs))
    return toxicity.score(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels"), languages), languages)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _read(spark, sf_dir, "labels")))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision.nearest(_read(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_read(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_read(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.audit(_read(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.annotate(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_source_mix, op2_line_dedup, op3_embedding_join, op4_packing, op5_language_id, op6_toxicity,
                            op7_quality, op8_nearest, op9_simhash, op10_html_text, op11_merkle_manifest, op12_periodic_runs, op13_license_scan)
}
SQL: dict[str, str] = {"op2_line_dedup": linededup.SQL, "op11_merkle_manifest": merkle.SQL,
                      "op12_periodic_runs": periodic.SQL, "op13_license_scan": license.SQL}
