"""Query registry: a Spark function and its SQL twin under one name.

`real` and `whole` name the result's double and integer columns; both sides get
the same rounding and casts, so that sums of doubles compare equal.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

MODULES = (
    "business", "fairness", "timefeatures", "quality", "statistics", "cleaning", "transforms",
    "splits", "models", "segments", "campaigns", "recommendations", "explanations", "streams",
)


class Tables:
    """Lazy parquet readers: `t.orders` reads orders.parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def query(name: str, sql: str | None = None, *, real: str = "", whole: str = "", digits: int = 6):
    reals, wholes = real.split(), whole.split()

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(Tables(spark, sf_dir))
            changes = {c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in reals}
            changes |= {c: F.col(c).cast("long") for c in wholes}
            return df.withColumns(changes) if changes else df

        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            casts = [f"round(CAST({c} AS DOUBLE), {digits}) + 0e0 AS {c}" for c in reals]
            casts += [f"CAST({c} AS BIGINT) AS {c}" for c in wholes]
            SQL[name] = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql
        return build

    return register


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"workload.{m}")
