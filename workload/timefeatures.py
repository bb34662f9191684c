"""Time features on orders (day level) and events (hour level), and the order joins."""

from pyspark.sql import functions as F

from retenta.operators import timefeat as T
from retenta.operators import transactions as X
from retenta.params import Transactions
from workload.registry import query

ORDERS = Transactions("o_custkey", "o_orderdate", "o_totalprice")
EVENTS = Transactions("user_id", "ts", "value")

RFM = """
g AS (
  SELECT o_custkey, max(o_orderdate) AS last_date, min(o_orderdate) AS first_date, count(o_orderdate) AS frequency,
         round_even(sum(o_totalprice), 2) AS monetary_total, round_even(round(sum(o_totalprice), 6) / count(o_totalprice), 2) AS monetary_avg,
         round_even(stddev_samp(o_totalprice), 2) AS monetary_std
  FROM orders GROUP BY o_custkey
),
rfm AS (
  SELECT *, date_sub('day', last_date, (SELECT max(o_orderdate) FROM orders)) AS recency_days,
         date_sub('day', first_date, last_date) AS customer_lifetime_days,
         frequency / (date_sub('day', first_date, last_date) + 1) AS transaction_rate,
         monetary_std / (monetary_avg + 1e-8) AS monetary_cv
  FROM g
)
"""
RFM_REAL = "monetary_total monetary_avg monetary_std transaction_rate monetary_cv"
RFM_WHOLE = "recency_days frequency customer_lifetime_days"


@query("rfm_features", "WITH " + RFM + "SELECT * FROM rfm", real=RFM_REAL, whole=RFM_WHOLE, digits=5)
def rfm_features(t):
    return T.rfm_features(t.orders, ORDERS)


SCORES = RFM + """,
e AS (SELECT quantile_cont(recency_days, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS r, quantile_cont(frequency, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS f,
             quantile_cont(monetary_total, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS m FROM rfm),
ee AS (SELECT list_sort(list_distinct(r)) AS r, list_sort(list_distinct(f)) AS f, list_sort(list_distinct(m)) AS m FROM e),
s AS (
  SELECT o_custkey,
    len(r) - (1 + len(list_filter(r[2:-2], lambda x: recency_days > x))) AS recency_score,
    1 + len(list_filter(f[2:-2], lambda x: frequency > x)) AS frequency_score,
    1 + len(list_filter(m[2:-2], lambda x: monetary_total > x)) AS monetary_score
  FROM rfm, ee
)
"""


@query("rfm_scores", "WITH " + SCORES + """SELECT *, recency_score * 100e0 + frequency_score * 10e0 + monetary_score AS rfm_score FROM s""",
       real="rfm_score", whole="recency_score frequency_score monetary_score")
def rfm_scores(t):
    return T.rfm_scores(T.rfm_features(t.orders, ORDERS)).select(
        "o_custkey", "recency_score", "frequency_score", "monetary_score", "rfm_score")


@query("recency", """SELECT o_custkey, date_sub('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS recency_days
  FROM orders GROUP BY o_custkey""", whole="recency_days")
def recency(t):
    return T.recency(t.orders, ORDERS)


@query("frequency", "SELECT o_custkey, count(o_orderdate) AS frequency FROM orders GROUP BY o_custkey", whole="frequency")
def frequency(t):
    return T.frequency(t.orders, ORDERS)


@query("monetary", "SELECT o_custkey, sum(o_totalprice) AS monetary FROM orders GROUP BY o_custkey", real="monetary", digits=2)
def monetary(t):
    return T.monetary(t.orders, ORDERS)


@query("orders_with_rfm", "WITH " + RFM + """SELECT o_orderkey, o_custkey, frequency, recency_days, monetary_total
  FROM orders LEFT JOIN rfm USING (o_custkey)""", real="monetary_total", whole="frequency recency_days", digits=2)
def orders_with_rfm(t):
    return T.add_rfm(t.orders, ORDERS).select("o_orderkey", "o_custkey", "frequency", "recency_days", "monetary_total")


@query("rfm_with_fitted_date", """SELECT o_custkey, date_sub('day', max(o_orderdate), (SELECT max(l_shipdate) FROM lineitem)) AS recency_days
  FROM orders GROUP BY o_custkey""", whole="recency_days")
def rfm_with_fitted_date(t):
    fitted = T.fit_reference_date(t.lineitem, Transactions("l_orderkey", "l_shipdate", "l_extendedprice"))
    return T.rfm_features(t.orders, ORDERS, F.lit(fitted).cast("timestamp_ntz")).select("o_custkey", "recency_days")


def _rolling_sql(key: str, ts: str, value: str, table: str, ident: str) -> str:
    parts, wins = [], []
    for d in (7, 30, 90):
        parts.append(f"sum({value}) OVER w{d} AS rolling_{d}d_sum, count({value}) OVER w{d} AS rolling_{d}d_count, "
                     f"avg({value}) OVER w{d} AS rolling_{d}d_mean")
        wins.append(f"w{d} AS (PARTITION BY {key} ORDER BY {ts} RANGE BETWEEN INTERVAL '{d} days' - INTERVAL 1 MICROSECOND "
                    "PRECEDING AND CURRENT ROW)")
    return f"SELECT {ident}, {key}, {', '.join(parts)} FROM {table} WINDOW {', '.join(wins)}"


ROLL_REAL = " ".join(f"rolling_{d}d_{k}" for d in (7, 30, 90) for k in ("sum", "mean"))
ROLL_WHOLE = " ".join(f"rolling_{d}d_count" for d in (7, 30, 90))


@query("rolling_orders", _rolling_sql("o_custkey", "o_orderdate", "o_totalprice", "orders", "o_orderkey"),
       real=ROLL_REAL, whole=ROLL_WHOLE)
def rolling_orders(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return T.rolling_features(o, tx=ORDERS).drop("o_orderdate", "o_totalprice")


@query("rolling_events", _rolling_sql("user_id", "ts", "value", "events", "event_id"),
       real=ROLL_REAL, whole=ROLL_WHOLE, digits=8)
def rolling_events(t):
    e = t.events.select("event_id", "user_id", "ts", "value")
    return T.rolling_features(e, tx=EVENTS).drop("ts", "value")


SESSIONS = """
lagged AS (SELECT user_id, ts, value, date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts), ts) / 36e8 AS gap FROM events),
numbered AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 24 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_id FROM lagged),
sess AS (
  SELECT user_id, session_id, min(ts) AS session_start, max(ts) AS session_end, count(ts) AS session_count,
         sum(value) AS session_sum, avg(value) AS session_mean, coalesce(sum(gap), 0) AS gap_hours_sum,
         date_diff('microsecond', min(ts), max(ts)) / 36e8 AS session_duration_hours
  FROM numbered GROUP BY user_id, session_id
)
"""


@query("sessions", "WITH " + SESSIONS + "SELECT * FROM sess",
       real="session_sum session_mean gap_hours_sum session_duration_hours", whole="session_id session_count", digits=4)
def sessions(t):
    return T.sessions(t.events, tx=EVENTS)


@query("session_summary", "WITH " + SESSIONS + """SELECT user_id, avg(session_count) AS count_mean, stddev_samp(session_count) AS count_std,
  sum(session_count) AS count_sum, avg(session_sum) AS value_mean, stddev_samp(session_sum) AS value_std,
  avg(session_duration_hours) AS duration_mean, stddev_samp(session_duration_hours) AS duration_std,
  max(session_duration_hours) AS duration_max FROM sess GROUP BY user_id""",
       real="count_mean count_std value_mean value_std duration_mean duration_std duration_max", whole="count_sum", digits=7)
def session_summary(t):
    return T.session_summary(T.sessions(t.events, tx=EVENTS), EVENTS)


@query("behaviour_patterns", """WITH g AS (
  SELECT user_id, round_even(avg(hour(ts)), 2) AS hour_mean, round_even(stddev_samp(hour(ts)), 2) AS hour_std,
    round_even(avg(isodow(ts) - 1), 2) AS weekday_mean, round_even(stddev_samp(isodow(ts) - 1), 2) AS weekday_std,
    count(DISTINCT month(ts)) AS active_months, round_even(avg(CASE WHEN isodow(ts) >= 6 THEN 1e0 ELSE 0e0 END), 2) AS weekend_share,
    round_even(avg(value), 2) AS value_mean, round_even(stddev_samp(value), 2) AS value_std,
    round_even(min(value), 2) AS value_min, round_even(max(value), 2) AS value_max
  FROM events GROUP BY user_id)
SELECT *, value_std / (value_mean + 1e-8) AS spending_volatility, 1 / (1 + hour_std) AS time_consistency,
  1 / (1 + weekday_std) AS day_consistency, value_max - value_min AS spending_range FROM g""",
       real="hour_mean hour_std weekday_mean weekday_std weekend_share value_mean value_std value_min value_max "
            "spending_volatility time_consistency day_consistency spending_range", whole="active_months", digits=5)
def behaviour_patterns(t):
    return T.behaviour_patterns(t.events, EVENTS)


def _trend_sql() -> str:
    parts = []
    for p in (30, 90, 180):
        c = f"o_orderdate >= ref - INTERVAL {p} DAY"
        parts.append(f"nullif(count(*) FILTER ({c}), 0) AS trend_{p}d_count, sum(o_totalprice) FILTER ({c}) AS trend_{p}d_sum, "
                     f"avg(o_totalprice) FILTER ({c}) AS trend_{p}d_mean")
    return f"""WITH r AS (SELECT max(o_orderdate) AS ref FROM orders),
g AS (SELECT o_custkey, {', '.join(parts)} FROM orders, r WHERE o_orderdate >= ref - INTERVAL 180 DAY GROUP BY o_custkey)
SELECT *, trend_30d_count / (trend_90d_count + 1e-8) AS frequency_trend_ratio, trend_30d_sum / (trend_90d_sum + 1e-8) AS spending_trend_ratio FROM g"""


@query("trend_features", _trend_sql(),
       real=" ".join(f"trend_{p}d_{k}" for p in (30, 90, 180) for k in ("sum", "mean")) + " frequency_trend_ratio spending_trend_ratio",
       whole="trend_30d_count trend_90d_count trend_180d_count", digits=4)
def trend_features(t):
    return T.trend_features(t.orders, tx=ORDERS)


# joins and order aggregates


@query("customer_orders", """SELECT c_custkey, c_mktsegment, o_orderkey, o_orderdate FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def customer_orders(t):
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return X.customer_orders(t.customer, o, "c_custkey").select("c_custkey", "c_mktsegment", "o_orderkey", "o_orderdate")


ITEMS = """SELECT l_orderkey AS order_id, count(l_linenumber) AS total_items, count(DISTINCT l_partkey) AS unique_products,
  round_even(sum(l_extendedprice), 2) AS total_price, round_even(round(sum(l_extendedprice), 6) / count(l_extendedprice), 2) AS avg_item_price,
  round_even(sum(l_tax), 2) AS total_freight FROM lineitem GROUP BY l_orderkey"""
ITEM_COLS = dict(order="l_orderkey", item="l_linenumber", product="l_partkey", price="l_extendedprice", freight="l_tax")


@query("order_summary", ITEMS, real="total_price avg_item_price total_freight", whole="total_items unique_products", digits=2)
def order_summary(t):
    return X.order_summary(t.lineitem, **ITEM_COLS).withColumnRenamed("l_orderkey", "order_id")


@query("orders_with_items", f"""SELECT o_orderkey, o_custkey, total_items, unique_products FROM orders LEFT JOIN ({ITEMS}) i ON i.order_id = o_orderkey""",
       whole="total_items unique_products")
def orders_with_items(t):
    s = X.order_summary(t.lineitem, **ITEM_COLS).withColumnRenamed("l_orderkey", "o_orderkey")
    return X.with_order_summary(t.orders, s, "o_orderkey").select("o_orderkey", "o_custkey", "total_items", "unique_products")


@query("churn_by_recency", """SELECT o_orderkey, date_sub('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS days_since_last_order,
  CASE WHEN date_sub('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) > 180 THEN 1 ELSE 0 END AS churn
  FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders)""",
       whole="days_since_last_order churn")
def churn_by_recency(t):
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    return X.churn_label(o, "o_orderdate").select("o_orderkey", "days_since_last_order", "churn")
