"""Split queries: orders in time, customers by class."""

from retenta.operators import splits as L
from workload.base import SCORED_SQL, scored
from workload.registry import query

WITH = "WITH " + SCORED_SQL
TEMPORAL = """ts AS (SELECT o_orderkey, o_custkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r, count(*) OVER () AS n FROM orders),
cuts AS (SELECT *, CAST(floor(n * 2e-1) AS BIGINT) AS nt FROM ts),
split AS (SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN r <= n - nt - floor((n - nt) * 2e-1) THEN 'train' WHEN r <= n - nt THEN 'val' ELSE 'test' END AS split FROM cuts)"""
STRAT = """,
hs AS (SELECT customer_id, label, row_number() OVER ({part} ORDER BY md5('42|' || customer_id), customer_id) AS r, count(*) OVER ({part}) AS n FROM scored),
split AS (SELECT customer_id, label, CASE WHEN r <= floor(n * 2e-1 + 5e-1) THEN 'test' WHEN r <= floor(n * (2e-1 + 2e-1) + 5e-1) THEN 'val' ELSE 'train' END AS split FROM hs)
"""


@query("temporal_split", f"WITH {TEMPORAL} SELECT o_orderkey, split FROM split")
def temporal_split(t):
    return L.temporal_split(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey").select("o_orderkey", "split")


@query("temporal_leakage", f"""WITH {TEMPORAL}, e AS (SELECT max(o_orderdate) FILTER (split = 'train') AS train_end, min(o_orderdate) FILTER (split = 'val') AS val_start,
  max(o_orderdate) FILTER (split = 'val') AS val_end, min(o_orderdate) FILTER (split = 'test') AS test_start FROM split)
  SELECT *, train_end >= val_start AS train_val_overlap, val_end >= test_start AS val_test_overlap FROM e""")
def temporal_leakage(t):
    return L.temporal_leakage(L.temporal_split(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey"), "o_orderdate")


@query("stratified_split", WITH + STRAT.format(part="PARTITION BY label") + "SELECT customer_id, label, split FROM split")
def stratified_split(t):
    return L.stratified_split(scored(t).select("customer_id", "label"), "customer_id", "label")


@query("random_split", WITH + STRAT.format(part="") + "SELECT customer_id, label, split FROM split")
def random_split(t):
    return L.random_split(scored(t).select("customer_id", "label"), "customer_id")


@query("split_summary", WITH + STRAT.format(part="PARTITION BY label") + """SELECT split, label, count(*) AS n, sum(count(*)) OVER (PARTITION BY split) AS split_rows,
  sum(count(*)) OVER (PARTITION BY split) / sum(count(*)) OVER () AS proportion, count(*) / sum(count(*)) OVER (PARTITION BY split) AS label_share FROM split GROUP BY split, label""",
       real="proportion label_share", whole="n split_rows")
def split_summary(t):
    return L.split_summary(L.stratified_split(scored(t).select("customer_id", "label"), "customer_id", "label"), "label")


@query("class_drift", WITH + STRAT.format(part="") + """,
sh AS (SELECT label, count(*) FILTER (split = 'train') / (SELECT count(*) FROM split WHERE split = 'train') AS train_share,
  count(*) FILTER (split = 'val') / (SELECT count(*) FROM split WHERE split = 'val') AS val_share,
  count(*) FILTER (split = 'test') / (SELECT count(*) FROM split WHERE split = 'test') AS test_share FROM split GROUP BY label)
SELECT *, abs(train_share - val_share) > 5e-2 OR abs(train_share - test_share) > 5e-2 AS drifts FROM sh""", real="train_share val_share test_share")
def class_drift(t):
    return L.class_drift(L.random_split(scored(t).select("customer_id", "label"), "customer_id"), "label")


@query("shuffle_splits", WITH + """, x AS (SELECT customer_id, label, CAST(s AS INTEGER) AS split, row_number() OVER (PARTITION BY s, label ORDER BY md5('42|' || s || '|' || customer_id), customer_id) AS r,
  count(*) OVER (PARTITION BY s, label) AS n FROM scored, range(5) g(s))
  SELECT split, customer_id, label, CASE WHEN r <= floor(n * (1e0 / 5) + 5e-1) THEN 'val' ELSE 'train' END AS role FROM x""")
def shuffle_splits(t):
    return L.shuffle_splits(scored(t), "customer_id", "label")


@query("stratified_folds", WITH + """SELECT customer_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42|' || customer_id), customer_id) - 1) % 5 AS INTEGER) AS fold FROM scored""")
def stratified_folds(t):
    return L.stratified_folds(scored(t).select("customer_id", "label"), "customer_id", "label")


@query("sample_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 1000")
def sample_rows(t):
    return L.sample_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 1000)
