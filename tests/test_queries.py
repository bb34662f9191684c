"""Registered queries against their SQL twins on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

DATA = "/root/testdata/sf0.001"
SOME = ["lift_table", "decile_profit", "model_metric_table", "fairness_report", "rfm_features", "rfm_scores", "rolling_events", "sessions",
        "trend_features", "quality_report", "profile_numeric", "impute", "chi_square", "mann_whitney", "spearman_pairs", "clean_telco",
        "clean_orders", "stratified_split", "numeric_standard", "target_encoding_cross_fitted", "registry_promote", "cluster_quality",
        "purchase_summary", "rank_customers", "recommendations", "campaign_summary", "explainer_agreement", "stream_sessions"]


def test_every_twin_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries()) and len(queries()) > 150


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries()[name](spark, DATA)
    cur = con.execute(oracle_sql()[name])
    theirs = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(theirs)
    mine = sorted(df.columns)

    def close(a, b):
        if isinstance(a, float) and isinstance(b, float):
            return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-5)
        return a == b

    key = lambda row: [repr(round(v, 3) if isinstance(v, float) else v) for v in row]
    left = sorted((tuple(r[c] for c in mine) for r in df.collect()), key=key)
    right = sorted((tuple(dict(zip(theirs, r))[c] for c in mine) for r in cur.fetchall()), key=key)
    assert len(left) == len(right)
    assert all(close(a, b) for x, y in zip(left, right) for a, b in zip(x, y))
