"""Shared inputs: a churn score per customer, derived from orders and customer.

label: last order more than 180 days before the newest order of all.
score: fixed arithmetic on order count and balance, so both engines get the
same bits; it is floored to four decimals, which also makes ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retenta.functions.expr import elapsed_days


def customers(t) -> DataFrame:
    """One row per customer with orders: recency, frequency, money, balance, groups."""
    o = t.orders
    newest = o.agg(F.max("o_orderdate")).scalar()
    per = o.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("frequency"),
        F.max("o_orderdate").alias("last_order"),
        F.min("o_orderdate").alias("first_order"),
        (F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / F.lit(100.0)).alias("monetary"),
    )
    per = per.withColumn("recency_days", elapsed_days(F.col("last_order"), newest))
    c = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation_key"),
    )
    return per.join(c, "customer_id")


CUSTOMERS_SQL = """
per AS (
  SELECT o_custkey AS customer_id, count(*) AS frequency, max(o_orderdate) AS last_order, min(o_orderdate) AS first_order,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 1e2 AS monetary,
         date_sub('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS recency_days
  FROM orders GROUP BY o_custkey
),
customers AS (
  SELECT per.*, c_acctbal AS balance, c_mktsegment AS segment, c_nationkey AS nation_key
  FROM per JOIN customer ON c_custkey = customer_id
)
"""


def scored(t) -> DataFrame:
    """(customer_id, label, score, score_b, segment, nation_key, monetary, frequency, balance)."""
    c = customers(t)
    poverty = (F.lit(9998.0) - F.col("balance")) / F.lit(11000.0)
    return c.select(
        "customer_id",
        (F.col("recency_days") > 180).cast("int").alias("label"),
        (F.floor(F.lit(10000.0) * (F.lit(0.7) * (F.lit(9.0) / (F.col("frequency") + F.lit(9.0))) + F.lit(0.3) * poverty))
         / F.lit(10000.0)).alias("score"),
        (F.floor(F.lit(10000.0) * poverty) / F.lit(10000.0)).alias("score_b"),
        "segment", "nation_key", "monetary", "frequency", "balance", "recency_days",
    )


SCORED_SQL = CUSTOMERS_SQL + """,
scored AS (
  SELECT customer_id, CASE WHEN recency_days > 180 THEN 1 ELSE 0 END AS label,
         floor(10000e0 * (7e-1 * (9e0 / (frequency + 9e0)) + 3e-1 * ((9998e0 - balance) / 11000e0))) / 10000e0 AS score,
         floor(10000e0 * ((9998e0 - balance) / 11000e0)) / 10000e0 AS score_b,
         segment, nation_key, monetary, frequency, balance, recency_days
  FROM customers
)
"""


def two_models(t) -> DataFrame:
    """Long form of both scores: (model, customer_id, label, score, segment)."""
    pair = F.array(
        F.struct(F.lit("order_count").alias("model"), F.col("score").alias("s")),
        F.struct(F.lit("balance_only").alias("model"), F.col("score_b").alias("s")),
    )
    return scored(t).withColumn("m", F.explode(pair)).select(
        F.col("m.model").alias("model"), "customer_id", "label", F.col("m.s").alias("score"), "segment")


TWO_MODELS_SQL = SCORED_SQL + """,
models AS (
  SELECT 'order_count' AS model, customer_id, label, score, segment FROM scored
  UNION ALL SELECT 'balance_only', customer_id, label, score_b, segment FROM scored
)
"""
