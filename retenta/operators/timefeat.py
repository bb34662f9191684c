"""Recency / frequency / monetary, rolling, session, behaviour and trend features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from retenta.functions.expr import cents, elapsed_days, elapsed_hours, ratio
from retenta.params import Transactions
from retenta.plans.order import BIN, assign_bins
from retenta.plans.quantiles import fit_quantiles

TINY = 1e-8


def reference_date(df: DataFrame, tx: Transactions) -> Column:
    """Newest date of the data as a scalar; pass a literal instead to reuse a fitted date."""
    return df.agg(F.max(tx.date)).scalar()


def fit_reference_date(df: DataFrame, tx: Transactions):
    """The newest date as a value, to be kept and reused on later data."""
    return df.agg(F.max(tx.date)).first()[0]


def rfm_features(df: DataFrame, tx: Transactions = Transactions(), reference: Column | None = None) -> DataFrame:
    """One row per customer; money aggregates are rounded half-even to cents before the ratios."""
    ref = reference_date(df, tx) if reference is None else reference
    v = F.col(tx.value)
    g = df.groupBy(tx.customer).agg(
        F.max(tx.date).alias("last_date"), F.min(tx.date).alias("first_date"), F.count(tx.date).alias("frequency"),
        cents(F.sum(v)).alias("monetary_total"), cents(F.round(F.sum(v), 6) / F.count(v)).alias("monetary_avg"),
        cents(F.stddev_samp(v)).alias("monetary_std"))
    life = elapsed_days(F.col("first_date"), F.col("last_date"))
    return g.select(
        tx.customer, "last_date", "first_date", elapsed_days(F.col("last_date"), ref).alias("recency_days"),
        "frequency", "monetary_total", "monetary_avg", "monetary_std",
        life.alias("customer_lifetime_days"),
        (F.col("frequency") / (life + 1)).alias("transaction_rate"),
        (F.col("monetary_std") / (F.col("monetary_avg") + F.lit(TINY))).alias("monetary_cv"))


def quantile_labels(value: Column, edges: Sequence[float | None]) -> tuple[Column, int]:
    """Right-closed quantile class 1..k (lowest included) over de-duplicated edges, and k."""
    inner = sorted({e for e in edges if e is not None})[1:-1]
    place = F.lit(1)
    for e in inner:
        place = place + F.when(value > F.lit(e), 1).otherwise(0)
    return F.when(value.isNotNull(), place), len(inner) + 1


def rfm_scores(rfm: DataFrame, quantiles: int = 5) -> DataFrame:
    """Quintile scores and 100R + 10F + M.

    Duplicate edges merge classes; the remaining classes are numbered from 1
    again, recency from the top down.
    """
    cols = ["recency_days", "frequency", "monetary_total"]
    edges = fit_quantiles(rfm, cols, [i / quantiles for i in range(quantiles + 1)])
    r, k = quantile_labels(F.col("recency_days"), edges["recency_days"])
    f, _ = quantile_labels(F.col("frequency"), edges["frequency"])
    m, _ = quantile_labels(F.col("monetary_total"), edges["monetary_total"])
    out = rfm.withColumns({"recency_score": F.lit(k + 1) - r, "frequency_score": f, "monetary_score": m})
    return out.withColumn("rfm_score", (F.col("recency_score") * 100 + F.col("frequency_score") * 10
                                        + F.col("monetary_score")).cast("double"))


def recency(df: DataFrame, tx: Transactions = Transactions(), reference: Column | None = None) -> DataFrame:
    ref = reference_date(df, tx) if reference is None else reference
    return df.groupBy(tx.customer).agg(F.max(tx.date).alias("last")).select(
        tx.customer, elapsed_days(F.col("last"), ref).alias("recency_days"))


def frequency(df: DataFrame, tx: Transactions = Transactions()) -> DataFrame:
    return df.groupBy(tx.customer).agg(F.count(tx.date).alias("frequency"))


def monetary(df: DataFrame, tx: Transactions = Transactions()) -> DataFrame:
    return df.groupBy(tx.customer).agg(F.sum(tx.value).alias("monetary"))


def add_rfm(df: DataFrame, tx: Transactions = Transactions(), reference: Column | None = None,
            scores: bool = False) -> DataFrame:
    """Transactions with their customer's RFM features; the row count does not change."""
    features = rfm_features(df, tx, reference)
    if scores:
        features = rfm_scores(features)
    return df.join(features, tx.customer, "left")


def rolling_features(df: DataFrame, windows: Sequence[int] = (7, 30, 90), tx: Transactions = Transactions()) -> DataFrame:
    """Per-row sum, count and mean over (t - w days, t] of the same customer.

    Rows with equal timestamps see each other, so the result does not depend
    on input order.  Time is cut into buckets as wide as the window: the window
    at t is what the previous bucket holds after t - w plus what t's own bucket
    holds up to t.  Both are running sums inside one bucket, so values are only
    ever added (no digits cancel), the cost per row does not grow with the
    window, and a busy customer's history spreads over tasks by bucket.
    """
    moments = df.withColumn("_us", F.unix_micros(F.col(tx.date).cast("timestamp")))
    base, moments = moments, moments.where(F.col("_us").isNotNull()).groupBy(tx.customer, "_us").agg(
        F.sum(tx.value).alias("_s"), F.count(tx.value).alias("_n"))
    # per window, a moment is a value in its own bucket and a question to the bucket before
    roles = F.array(*[F.struct(F.lit(int(d)).cast("long").alias("w"), F.lit(ask).alias("ask"))
                      for d in windows for ask in (False, True)])
    width = F.col("_w") * F.lit(86_400_000_000)
    marks = moments.withColumn("_role", F.explode(roles)).select(
        tx.customer, "_us", "_s", "_n", F.col("_role.w").alias("_w"), F.col("_role.ask").alias("_ask"))
    marks = marks.withColumns({
        "_at": F.when(F.col("_ask"), F.col("_us") - width).otherwise(F.col("_us")),
        "_s": F.when(~F.col("_ask"), F.col("_s")), "_n": F.when(~F.col("_ask"), F.col("_n"))})
    marks = marks.withColumn("_start", F.col("_at") - F.pmod(F.col("_at"), width))
    bucket = W.partitionBy(tx.customer, "_w", "_start")
    upto = bucket.orderBy("_at", "_ask").rowsBetween(W.unboundedPreceding, W.currentRow)
    # a question at t - w comes before the value of that moment, which the window leaves out
    after = bucket.orderBy(F.desc("_at"), F.desc("_ask")).rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = marks.select(tx.customer, "_us", "_w", *[
        F.when(F.col("_ask"), F.sum(c).over(after)).otherwise(F.sum(c).over(upto)).alias(c) for c in ("_s", "_n")])
    aggs = []
    for d in windows:
        inside = F.col("_w") == int(d)
        n, s = F.sum(F.when(inside, F.col("_n"))), F.sum(F.when(inside, F.col("_s")))
        aggs += [s.alias(f"rolling_{d}d_sum"), n.alias(f"rolling_{d}d_count"), ratio(s, n).alias(f"rolling_{d}d_mean")]
    totals = parts.groupBy(tx.customer, "_us").agg(*aggs)
    return base.join(totals, [tx.customer, "_us"], "left").drop("_us")


def sessions(df: DataFrame, gap_hours: int = 24, tx: Transactions = Transactions()) -> DataFrame:
    """Sessions by inactivity: a new one starts when the gap exceeds the threshold.

    `gap_hours_sum` includes the gap before the session, as recorded on its first row.
    Customers are cut into time bins, so one busy customer spreads over tasks;
    the last moment and the session count of earlier bins are carried over.
    """
    slot = [tx.customer, BIN]
    binned = assign_bins(df, tx.date)
    earlier = W.partitionBy(tx.customer).orderBy(BIN)
    edges = binned.groupBy(*slot).agg(F.max(tx.date).alias("_last")).select(
        *slot, F.lag("_last").over(earlier).alias("_prev"))
    inside = W.partitionBy(*slot).orderBy(tx.date)
    marked = binned.join(edges, slot).withColumn(
        "_gap", elapsed_hours(F.coalesce(F.lag(tx.date).over(inside), F.col("_prev")), F.col(tx.date)))
    marked = marked.withColumn("_new", F.when(F.col("_gap").isNull() | (F.col("_gap") > gap_hours), 1).otherwise(0))
    before = earlier.rowsBetween(W.unboundedPreceding, -1)
    offsets = marked.groupBy(*slot).agg(F.sum("_new").alias("_k")).select(
        *slot, F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_off"))
    # a range frame: rows with equal timestamps belong to the same session
    upto = inside.rangeBetween(W.unboundedPreceding, W.currentRow)
    numbered = marked.join(offsets, slot).withColumn("session_id", F.col("_off") + F.sum("_new").over(upto))
    out = numbered.groupBy(tx.customer, "session_id").agg(
        F.min(tx.date).alias("session_start"), F.max(tx.date).alias("session_end"),
        F.count(tx.date).alias("session_count"), F.sum(tx.value).alias("session_sum"),
        F.avg(tx.value).alias("session_mean"), F.coalesce(F.sum("_gap"), F.lit(0.0)).alias("gap_hours_sum"))
    return out.withColumn("session_duration_hours", elapsed_hours(F.col("session_start"), F.col("session_end")))


def session_summary(session_rows: DataFrame, tx: Transactions = Transactions()) -> DataFrame:
    """Per customer: spread of session sizes, values and durations (sample deviations)."""
    return session_rows.groupBy(tx.customer).agg(
        F.avg("session_count").alias("count_mean"), F.stddev_samp("session_count").alias("count_std"),
        F.sum("session_count").alias("count_sum"), F.avg("session_sum").alias("value_mean"),
        F.stddev_samp("session_sum").alias("value_std"), F.avg("session_duration_hours").alias("duration_mean"),
        F.stddev_samp("session_duration_hours").alias("duration_std"),
        F.max("session_duration_hours").alias("duration_max"))


def behaviour_patterns(df: DataFrame, tx: Transactions = Transactions()) -> DataFrame:
    """Hour, weekday (Monday 0), month and spending habits; aggregates rounded to 2 before the ratios."""
    d, v = F.col(tx.date), F.col(tx.value)
    hour, weekday = F.hour(d), F.weekday(d)

    g = df.groupBy(tx.customer).agg(
        cents(F.avg(hour)).alias("hour_mean"), cents(F.stddev_samp(hour)).alias("hour_std"),
        cents(F.avg(weekday)).alias("weekday_mean"), cents(F.stddev_samp(weekday)).alias("weekday_std"),
        F.count_distinct(F.month(d)).alias("active_months"),
        cents(F.avg((weekday >= 5).cast("double"))).alias("weekend_share"),
        cents(F.avg(v)).alias("value_mean"), cents(F.stddev_samp(v)).alias("value_std"),
        cents(F.min(v)).alias("value_min"), cents(F.max(v)).alias("value_max"))
    return g.withColumns({
        "spending_volatility": F.col("value_std") / (F.col("value_mean") + F.lit(TINY)),
        "time_consistency": 1 / (1 + F.col("hour_std")),
        "day_consistency": 1 / (1 + F.col("weekday_std")),
        "spending_range": F.col("value_max") - F.col("value_min"),
    })


def trend_features(df: DataFrame, periods: Sequence[int] = (30, 90, 180), tx: Transactions = Transactions(),
                   reference: Column | None = None) -> DataFrame:
    """Count, sum and mean since reference - period for every period in one aggregate.

    Customers with no row in the widest period are absent; a period without
    rows gives NULL.
    """
    ref = reference_date(df, tx) if reference is None else reference
    d, v = F.col(tx.date), F.col(tx.value)
    # compare against ref - period so the scan can filter on the widest period
    start = {p: ref - F.expr(f"INTERVAL '{int(p)}' DAY") for p in periods}
    recent = df.where(d >= start[max(periods)])
    aggs = []
    for p in periods:
        inside = d >= start[p]
        n = F.count(F.when(inside, d))
        aggs += [F.when(n > 0, n).alias(f"trend_{p}d_count"), F.sum(F.when(inside, v)).alias(f"trend_{p}d_sum"),
                 F.avg(F.when(inside, v)).alias(f"trend_{p}d_mean")]
    out = recent.groupBy(tx.customer).agg(*aggs)
    if len(periods) >= 2:
        a, b = periods[0], periods[1]
        out = out.withColumns({
            "frequency_trend_ratio": F.col(f"trend_{a}d_count") / (F.col(f"trend_{b}d_count") + F.lit(TINY)),
            "spending_trend_ratio": F.col(f"trend_{a}d_sum") / (F.col(f"trend_{b}d_sum") + F.lit(TINY)),
        })
    return out
