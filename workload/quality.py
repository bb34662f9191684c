"""Quality, profile and outlier queries on lineitem, orders and customer."""

from pyspark.sql import functions as F

from retenta.operators import quality as Q
from workload.base import SCORED_SQL, scored
from workload.registry import query

LINE = ["l_quantity", "l_extendedprice", "l_discount"]


def gappy_lines(t):
    """lineitem with injected NULLs, as the tables have none."""
    return t.lineitem.select(
        "l_orderkey", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount", F.when(F.col("l_suppkey") % 11 != 0, F.col("l_returnflag")).alias("l_returnflag"), "l_linestatus")


GAPPY = """gappy AS (SELECT l_orderkey, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity,
  CASE WHEN l_partkey % 5 <> 0 THEN l_extendedprice END AS l_extendedprice, l_discount,
  CASE WHEN l_suppkey % 11 <> 0 THEN l_returnflag END AS l_returnflag, l_linestatus FROM lineitem)"""


def _report_sql() -> str:
    parts = []
    types = {"l_orderkey": "bigint", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
             "l_returnflag": "string", "l_linestatus": "string"}
    for c, ty in types.items():
        if ty == "string":
            out = "NULL::BIGINT"
        else:
            out = (f"(SELECT count(*) FROM gappy, (SELECT quantile_cont({c}, 0.25) q1, quantile_cont({c}, 0.75) q3 FROM gappy) "
                   f"WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1))")
        parts.append(f"SELECT '{c}' AS \"column\", '{ty}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS missing_count, "
                     f"(count(*) - count({c})) * 100e0 / count(*) AS missing_percentage, {out} AS outlier_count FROM gappy")
    return f"WITH {GAPPY} " + " UNION ALL ".join(parts)


@query("quality_report", _report_sql(), real="missing_percentage", whole="n_rows missing_count outlier_count")
def quality_report(t):
    return Q.quality_report(gappy_lines(t))


@query("duplicate_rows", """SELECT count(*) AS n_rows, 3 AS n_columns, count(*) - (SELECT count(*) FROM
  (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)) AS duplicate_rows FROM lineitem""",
       whole="n_rows n_columns duplicate_rows")
def duplicate_rows(t):
    return Q.duplicate_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("iqr_outliers", """WITH priced AS (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN o_totalprice * 20 ELSE o_totalprice END AS o_totalprice FROM orders),
  b AS (SELECT quantile_cont(o_totalprice, 0.25) q1, quantile_cont(o_totalprice, 0.75) q3 FROM priced)
  SELECT o_orderkey, o_totalprice < q1 - 1.5e0 * (q3 - q1) OR o_totalprice > q3 + 1.5e0 * (q3 - q1) AS is_outlier FROM priced, b""")
def iqr_outliers(t):
    o = spiked_orders(t)
    return Q.iqr_outliers(o, ["o_totalprice"]).select("o_orderkey", "is_outlier")


def spiked_orders(t):
    return t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 100 == 0, F.col("o_totalprice") * 20)
                           .otherwise(F.col("o_totalprice")).alias("o_totalprice"))


@query("zscore_outliers", """WITH priced AS (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN o_totalprice * 20 ELSE o_totalprice END AS p FROM orders),
  s AS (SELECT avg(p) a, stddev_samp(p) d FROM priced) SELECT o_orderkey, abs((p - a) / d) > 3 AS is_outlier FROM priced, s""")
def zscore_outliers(t):
    return Q.zscore_outliers(spiked_orders(t), ["o_totalprice"]).select("o_orderkey", "is_outlier")


@query("winsorise", """WITH b AS (SELECT quantile_cont(c_acctbal, 0.01) lo, quantile_cont(c_acctbal, 0.99) hi FROM customer)
  SELECT c_custkey, least(greatest(c_acctbal, lo), hi) AS c_acctbal FROM customer, b""", real="c_acctbal")
def winsorise(t):
    return Q.winsorise(t.customer, ["c_acctbal"]).select("c_custkey", "c_acctbal")


@query("winsorise_fitted", """WITH b AS (SELECT quantile_cont(c_acctbal, 0.01) lo, quantile_cont(c_acctbal, 0.99) hi FROM customer)
  SELECT s_suppkey, least(greatest(s_acctbal, lo), hi) AS s_acctbal FROM supplier, b""", real="s_acctbal")
def winsorise_fitted(t):
    low_high = Q.fit_winsor(t.customer, ["c_acctbal"])["c_acctbal"]
    return Q.apply_winsor(t.supplier, {"s_acctbal": low_high}).select("s_suppkey", "s_acctbal")


@query("impute", f"""WITH {GAPPY},
  kept AS (SELECT * FROM gappy WHERE l_returnflag IS NOT NULL),
  m AS (SELECT avg(l_quantity) a, quantile_cont(l_extendedprice, 0.5) md FROM kept)
  SELECT l_orderkey, l_returnflag, count(*) AS n, sum(coalesce(l_quantity, a)) AS quantity, sum(coalesce(l_extendedprice, md)) AS price
  FROM kept, m GROUP BY l_orderkey, l_returnflag""", real="quantity price", whole="n", digits=4)
def impute(t):
    df = Q.impute(gappy_lines(t), {"l_returnflag": "drop", "l_quantity": "mean", "l_extendedprice": "median"})
    return df.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"),
                                                        F.sum("l_extendedprice").alias("price"))


@query("impute_mode", f"""WITH {GAPPY}, md AS (SELECT l_returnflag AS v FROM gappy WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
  SELECT coalesce(l_returnflag, v) AS l_returnflag, count(*) AS n FROM gappy, md GROUP BY 1""", whole="n")
def impute_mode(t):
    df = Q.impute(gappy_lines(t), {"l_returnflag": "mode"})
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("forward_fill", """WITH g AS (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN value END AS value FROM events)
  SELECT event_id, last_value(value IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM g""", real="value")
def forward_fill(t):
    e = t.events.select("event_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    return Q.impute(e, {"value": "forward_fill"}, order=("ts", "event_id")).select("event_id", "value")


def _profile_sql() -> str:
    return f"WITH {GAPPY} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, (count(*) - count({c})) * 100e0 / count(*) AS missing_percentage, "
        f"count(DISTINCT {c}) AS unique_count, avg({c}) AS mean, quantile_cont({c}, 0.5) AS median, stddev_samp({c}) AS std, min({c}) AS min, "
        f"max({c}) AS max, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.75) AS q75, skewness({c}) AS skewness, kurtosis({c}) AS kurtosis FROM gappy"
        for c in LINE)


@query("profile_numeric", _profile_sql(), whole="missing_count unique_count",
       real="missing_percentage mean median std min max q25 q75 skewness kurtosis", digits=8)
def profile_numeric(t):
    return Q.profile_numeric(gappy_lines(t), LINE)


@query("profile_categorical", """WITH v AS (SELECT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders),
  c AS (SELECT "column", value, count(*) AS frequency FROM v GROUP BY ALL)
  SELECT "column", CAST(row_number() OVER (PARTITION BY "column" ORDER BY frequency DESC, value) AS INTEGER) AS rank, value, frequency,
    frequency * 100e0 / sum(frequency) OVER (PARTITION BY "column") AS percentage, count(*) OVER (PARTITION BY "column") AS unique_count
  FROM c QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY frequency DESC, value) <= 10""",
       real="percentage", whole="frequency unique_count")
def profile_categorical(t):
    return Q.profile_categorical(t.orders, ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("missing_report", f"WITH {GAPPY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{ty}' AS data_type, count(*) - count({c}) AS missing_count, (count(*) - count({c})) * 100e0 / count(*) AS missing_percentage, "
    f"count(DISTINCT {c}) AS unique_count FROM gappy HAVING count(*) > count({c})"
    for c, ty in (("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_returnflag", "string"))),
       real="missing_percentage", whole="missing_count unique_count")
def missing_report(t):
    return Q.missing_report(gappy_lines(t))


@query("overall_summary", "WITH " + SCORED_SQL + """SELECT count(*) AS n_rows, avg(label) AS label_rate,
  (count(*) * 4 - count(customer_id) - count(label) - count(score) - count(segment)) * 100e0 / (count(*) * 4) AS missing_percentage FROM scored""",
       real="label_rate missing_percentage", whole="n_rows")
def overall_summary(t):
    return Q.overall_summary(scored(t).select("customer_id", "label", "score", "segment"), "label")


@query("describe_by_label", "WITH " + SCORED_SQL + " UNION ALL ".join(
    f"SELECT label, '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, "
    f"quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q75 FROM scored GROUP BY label"
    for c in ("monetary", "frequency", "balance")), real="mean std min max q25 median q75", whole="count", digits=5)
def describe_by_label(t):
    return Q.describe_by(scored(t), "label", ["monetary", "frequency", "balance"])


@query("histogram_by_label", "WITH " + SCORED_SQL + """, s AS (SELECT label, min(balance) lo, max(balance) hi, count(*) k FROM scored GROUP BY label),
  b AS (SELECT label, CAST(least(floor((balance - lo) / ((hi - lo) / 30e0)), 29) AS INTEGER) AS bin, lo, hi, k FROM scored JOIN s USING (label))
  SELECT label, bin, lo + bin * ((hi - lo) / 30e0) AS left_edge, count(*) AS n, count(*) / (k * ((hi - lo) / 30e0)) AS density
  FROM b GROUP BY label, bin, lo, hi, k""", real="left_edge density", whole="n")
def histogram_by_label(t):
    return Q.histogram(scored(t), "balance", "label")


@query("value_counts_by_label", "WITH " + SCORED_SQL + """SELECT label, 'segment' AS "column", segment AS value, count(*) AS n FROM scored GROUP BY ALL
  UNION ALL SELECT label, 'nation_key', CAST(nation_key AS VARCHAR), count(*) FROM scored GROUP BY ALL""", whole="n")
def value_counts_by_label(t):
    return Q.value_counts(scored(t), ["segment", "nation_key"], ["label"])
