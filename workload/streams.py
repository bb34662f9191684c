"""Structured Streaming over events, run to the end of the available data."""

import uuid

from pyspark.sql import functions as F

from retenta.session import work_folder
from retenta.streaming import operators as ST
from workload.registry import query
from workload.timefeatures import EVENTS, SESSIONS


def _stream(t):
    return ST.read_stream(t.spark, t.dir, "events.parquet", t.events.schema)


def _finish(t, stream, keys=None):
    """The result of all batches: windows are updated by their keys; closed sessions are appended and the open ones join them."""
    base = f"{work_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    if keys:
        out = ST.run_updates(stream, keys, f"{base}/out", f"{base}/checkpoint")
    else:
        out = ST.run_available(stream, f"{base}/out", f"{base}/checkpoint")
        out = out.unionByName(ST.open_sessions(t.spark, f"{base}/checkpoint", EVENTS))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c, k in out.dtypes if k == "timestamp"})


@query("stream_sessions", "WITH " + SESSIONS + """SELECT user_id, session_start, session_end, session_count, session_sum FROM sess""", real="session_sum", whole="session_count", digits=4)
def stream_sessions(t):
    return _finish(t, ST.session_totals(_stream(t), tx=EVENTS))


@query("stream_rolling", """WITH w AS (SELECT user_id, value, unnest(generate_series(date_trunc('day', ts) - INTERVAL 6 DAY, date_trunc('day', ts), INTERVAL 1 DAY)) AS window_start FROM events)
  SELECT user_id, window_start, window_start + INTERVAL 7 DAY AS window_end, sum(value) AS window_sum, count(value) AS window_count, avg(value) AS window_mean FROM w GROUP BY ALL""", real="window_sum window_mean", whole="window_count", digits=7)
def stream_rolling(t):
    return _finish(t, ST.rolling_totals(_stream(t), "7 days", "1 day", tx=EVENTS), ["user_id", "window_start"])


@query("stream_kpis", """SELECT date_trunc('day', ts) AS window_start, count(*) AS scored, count(*) FILTER (s > 7e-1) AS high_risk, count(*) FILTER (s > 7e-1) * 100e0 / count(*) AS high_risk_pct, avg(s) AS avg_risk
  FROM (SELECT ts, (user_id % 10) / 10e0 AS s FROM events) GROUP BY 1""",
       real="high_risk_pct avg_risk", whole="scored high_risk")
def stream_kpis(t):
    return _finish(t, ST.window_kpis(_stream(t).withColumn("score", (F.col("user_id") % 10) / F.lit(10.0)), tx=EVENTS), ["window_start"])
