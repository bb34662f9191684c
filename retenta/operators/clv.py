"""Customer lifetime value: purchase summaries, BG/NBD and Gamma-Gamma fits, predictions.

The fits follow the public models of Fader, Hardie and Lee (2005) and Fader and
Hardie (2013).  Each optimiser step is one Spark job: every task returns sums
of the log-likelihood at a small grid of parameter points around the current
one, and only those few sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from retenta.functions.expr import elapsed_days
from retenta.params import Transactions
from retenta.session import settle


def purchase_summary(df: DataFrame, tx: Transactions = Transactions("customer_id", "order_date", "order_value")) -> DataFrame:
    """Day-level summary: frequency = purchase days - 1, recency = last - first, T = newest - first,
    monetary_value = mean daily value without the first day (0 without repeats)."""
    day = F.to_date(tx.date)
    end = df.agg(F.max(day)).scalar()
    daily = df.groupBy(tx.customer, day.alias("day")).agg(F.sum(tx.value).alias("v"))
    g = daily.groupBy(tx.customer).agg(
        F.count(F.lit(1)).alias("days"), F.min("day").alias("first"), F.max("day").alias("last"),
        F.sum("v").alias("total"), F.min_by("v", "day").alias("first_value"))
    repeat = F.col("days") - 1
    return g.select(
        tx.customer, repeat.alias("frequency"), F.date_diff("last", "first").cast("double").alias("recency"),
        F.date_diff(end, F.col("first")).cast("double").alias("T"),
        F.when(repeat > 0, (F.col("total") - F.col("first_value")) / repeat).otherwise(F.lit(0.0)).alias("monetary_value"))


def purchase_summary_simple(df: DataFrame, tx: Transactions = Transactions("customer_id", "order_date", "order_value")) -> DataFrame:
    """Row-level summary: frequency = rows - 1, recency = days since last, T = age, monetary_value = sum."""
    end = df.agg(F.max(tx.date)).scalar()
    g = df.groupBy(tx.customer).agg(F.count(tx.date).alias("k"), F.max(tx.date).alias("last"), F.min(tx.date).alias("first"),
                                    F.sum(tx.value).alias("monetary_value"))
    return g.select(tx.customer, F.greatest(F.col("k") - 1, F.lit(0)).alias("frequency"),
                    elapsed_days(F.col("last"), end).alias("recency"), elapsed_days(F.col("first"), end).alias("T"), "monetary_value")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling series after shifting the argument above 10."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    z = x.copy()
    for _ in range(10):
        small = z < 10
        shift = np.where(small, shift - np.log(np.where(small, z, 1.0)), shift)
        z = np.where(small, z + 1, z)
    inv = 1 / z
    i2 = inv * inv
    series = inv * (1 / 12 - i2 * (1 / 360 - i2 * (1 / 1260 - i2 * (1 / 1680 - i2 / 1188))))
    return shift + (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series


def bgnbd_terms(p: np.ndarray, x: np.ndarray, tx: np.ndarray, T: np.ndarray) -> np.ndarray:
    """Per-customer BG/NBD log-likelihood at p = (r, alpha, a, b)."""
    r, alpha, a, b = p
    first = log_gamma(r + x) - log_gamma(r) + r * np.log(alpha)
    second = log_gamma(a + b) + log_gamma(b + x) - log_gamma(b) - log_gamma(a + b + x)
    alive = -(r + x) * np.log(alpha + T)
    gone = np.where(x > 0, np.log(a) - np.log(b + np.maximum(x, 1) - 1) - (r + x) * np.log(alpha + tx), -np.inf)
    return first + second + np.logaddexp(alive, gone)


def gamma_gamma_terms(p: np.ndarray, x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Per-customer Gamma-Gamma log-likelihood at p = (p, q, v)."""
    pp, q, v = p
    return (log_gamma(pp * x + q) - log_gamma(pp * x) - log_gamma(q) + q * np.log(v) + (pp * x - 1) * np.log(m)
            + pp * x * np.log(x) - (pp * x + q) * np.log(x * m + v))


def _sums(data: DataFrame, cols: Sequence[str], terms: Callable, points: np.ndarray) -> np.ndarray:
    """Weighted log-likelihood sums at every row of `points`: one job, one row per task, then one sum."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(points))
        for b in batches:
            args = [b[c].to_numpy(float) for c in cols]
            w = b["n"].to_numpy(float)
            total += np.array([float((w * terms(np.exp(p), *args)).sum()) for p in points])
        yield pd.DataFrame({"i": np.arange(len(points)), "v": total})

    rows = data.mapInPandas(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(points))
    for r in rows:
        out[r["i"]] = r["v"]
    return out


@dataclass(frozen=True)
class Fit:
    params: tuple[float, ...]
    log_likelihood: float
    n: int

    @property
    def aic(self) -> float:
        return 2 * len(self.params) - 2 * self.log_likelihood


def _newton(data: DataFrame, cols: Sequence[str], terms: Callable, start: Sequence[float], n: float, penalty: float,
            steps: int = 40, h: float = 1e-3, tolerance: float = 1e-6) -> tuple[np.ndarray, float]:
    """Damped Newton on log-parameters; value, gradient and Hessian by central differences in one job per step."""
    theta, k, damp = np.log(np.asarray(start, float)), len(start), 1e-3
    eye = np.eye(k) * h
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]

    def stencil(c: np.ndarray) -> np.ndarray:
        return np.array([c, *[c + s * eye[i] for i in range(k) for s in (1, -1)], *[c + eye[i] + eye[j] for i, j in pairs]])

    def cost(points: np.ndarray) -> np.ndarray:
        return -_sums(data, cols, terms, points) / n + penalty * (np.exp(points) ** 2).sum(axis=1)

    f = cost(stencil(theta))
    for _ in range(steps):
        up, down = f[1:1 + 2 * k:2], f[2:2 + 2 * k:2]
        grad = (up - down) / (2 * h)
        hess = np.diag((up - 2 * f[0] + down) / h**2)
        for m, (i, j) in enumerate(pairs):
            hess[i, j] = hess[j, i] = (f[1 + 2 * k + m] - up[i] - up[j] + f[0]) / h**2
        if np.abs(grad).max() < tolerance:
            break
        values, vectors = np.linalg.eigh(hess)
        moved = False
        while damp < 1e8:
            move = -vectors @ ((vectors.T @ grad) / (np.abs(values) + damp))
            move *= min(1.0, 1.5 / max(np.abs(move).max(), 1e-12))
            trial = cost(stencil(theta + move))
            if np.isfinite(trial[0]) and trial[0] < f[0]:
                theta, f, damp, moved = theta + move, trial, max(damp / 10, 1e-9), True
                break
            damp *= 10
        if not moved:
            break
    return np.exp(theta), f[0]


def fit_bgnbd(summary: DataFrame, penalty: float = 0.01) -> Fit:
    """BG/NBD maximum likelihood with an L2 penalty on the parameters, times scaled so that max T = 10."""
    top = summary.agg(F.max("T")).first()[0]
    scale = 10.0 / top if top else 1.0
    data = summary.groupBy("frequency", (F.col("recency") * scale).alias("tx"), (F.col("T") * scale).alias("tt")).agg(
        F.count(F.lit(1)).alias("n"))
    data = settle(data.select(F.col("frequency").cast("double").alias("x"), "tx", "tt", "n"), "bgnbd")
    n = data.agg(F.sum("n")).first()[0]
    p, _ = _newton(data, ["x", "tx", "tt"], bgnbd_terms, (1.0, 1.0, 1.0, 1.0), n, penalty)
    ll = float(_sums(data, ["x", "tx", "tt"], bgnbd_terms, np.log(p)[None, :])[0])
    r, alpha, a, b = p
    # back to days: the density of the purchase times changes by scale per purchase
    extra = data.agg(F.sum(F.col("x") * F.col("n"))).first()[0] * float(np.log(scale))
    return Fit((float(r), float(alpha / scale), float(a), float(b)), ll + extra, int(n))


def fit_gamma_gamma(summary: DataFrame, penalty: float = 0.01) -> Fit | None:
    """Gamma-Gamma maximum likelihood on repeat customers; None without any."""
    data = summary.where((F.col("frequency") > 0) & (F.col("monetary_value") > 0)).groupBy(
        F.col("frequency").cast("double").alias("x"), F.col("monetary_value").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    data = settle(data, "gamma-gamma")
    n = data.agg(F.sum("n")).first()[0]
    if not n:
        return None
    p, _ = _newton(data, ["x", "m"], gamma_gamma_terms, (1.0, 1.0, 1.0), n, penalty)
    ll = float(_sums(data, ["x", "m"], gamma_gamma_terms, np.log(p)[None, :])[0])
    return Fit(tuple(float(v) for v in p), ll, int(n))


class NotConverged(ArithmeticError):
    """A series whose terms are not negligible after the allowed number."""


def _c_hyp2f1(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray, most: int = 2_000_000) -> np.ndarray:
    """c x Gauss series for 0 <= z < 1 and c > -1, finite at c = 0 too; rows leave as soon as their terms are negligible."""
    a, b, c, z = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, c, z)))
    term = a * b * z
    total = c + term
    going = np.flatnonzero(np.abs(term) > 1e-15 * np.abs(total))
    for k in range(1, most):
        if not len(going):
            return total
        term = term[going] if k == 1 else term
        A, B, C, Z = a[going], b[going], c[going], z[going]
        term = term * (A + k) * (B + k) / ((C + k) * (k + 1)) * Z
        total[going] += term
        # terms may still grow before they fall, so a row leaves only behind the turn
        on = (np.abs(term) > 1e-15 * np.abs(total[going])) | ((A + k) * (B + k) * Z > (C + k) * (k + 1))
        going, term = going[on], term[on]
    raise NotConverged(f"{len(going)} rows after {most} terms: their observation is too short for the horizon")


def _hyp2f1(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss series for 0 <= z < 1 and c > 0."""
    return _c_hyp2f1(a, b, c, z) / c


def _expected(r: float, alpha: float, a: float, b: float, horizon: float, x: np.ndarray, tx: np.ndarray, T: np.ndarray) -> np.ndarray:
    """Conditional expectation of purchases in the horizon; a = 1 is the limit from both sides."""
    if abs(a - 1) < 1e-4:
        return (_expected(r, alpha, 1 - 1.5e-4, b, horizon, x, tx, T) + _expected(r, alpha, 1 + 1.5e-4, b, horizon, x, tx, T)) / 2
    c = a + b + x - 1
    base = (alpha + T) / (alpha + T + horizon)
    numer = (c - base ** (r + x) * _c_hyp2f1(r + x, b + x, c, horizon / (alpha + T + horizon))) / (a - 1)
    gone = np.where(x > 0, a / (b + np.maximum(x, 1) - 1) * ((alpha + T) / (alpha + tx)) ** (r + x), 0.0)
    return numer / (1 + gone)


def expected_purchases(fit: Fit, horizon: float) -> Callable[[Column, Column, Column], Column]:
    """Arrow function (frequency, recency, T) -> expected purchases in the next `horizon` days.

    Finite for all positive parameters; NULL inputs give NULL, and a series that
    does not converge raises NotConverged instead of returning what it has.
    """
    params = fit.params

    @F.pandas_udf(DoubleType())
    def expect(x: pd.Series, tx: pd.Series, T: pd.Series) -> pd.Series:
        x, tx, T = (s.to_numpy(float, na_value=np.nan) for s in (x, tx, T))
        known = ~(np.isnan(x) | np.isnan(tx) | np.isnan(T))
        out = np.full(len(x), np.nan)
        out[known] = _expected(*params, horizon, x[known], tx[known], T[known])
        return pd.Series(out).astype(object).where(known, None)

    return expect


def expected_value_per_purchase(fit: Fit, x: Column, m: Column) -> Column:
    """Gamma-Gamma conditional mean: own average shrunk towards the population mean.

    One fraction, so q = 1 needs no care; where even it has no positive divisor
    (q < 1 and few purchases) the mean is infinite and the own average stays.
    """
    p, q, v = fit.params
    below = p * x + F.lit(q - 1)
    return F.when(below > 0, F.lit(p) * (v + x * m) / below).otherwise(m)


def with_interval(df: DataFrame, share: float) -> DataFrame:
    c = F.col("predicted_clv")
    return df.withColumns({"clv_lower_ci": F.greatest(c - 1.96 * share * c, F.lit(0.0)), "clv_upper_ci": c + 1.96 * share * c})


def predict_clv(summary: DataFrame, ident: str, purchases: Fit, money: Fit | None, horizon: int = 365,
                monthly_rate: float = 0.01, annuity_on_total: bool = True) -> DataFrame:
    """Expected purchases x expected value; the annuity factor multiplies the whole total
    (annuity_on_total=False spreads the total evenly over the months instead)."""
    x, tx, T, m = F.col("frequency"), F.col("recency"), F.col("T"), F.col("monetary_value")
    value = m if money is None else F.when(x > 0, expected_value_per_purchase(money, x, m)).otherwise(m)
    factor = 1.0
    if monthly_rate > 0:
        months = horizon / 30
        factor = (1 - (1 + monthly_rate) ** -months) / monthly_rate / (1 if annuity_on_total else months)
    out = summary.withColumn("predicted_clv", expected_purchases(purchases, float(horizon))(x, tx, T) * value * F.lit(factor))
    return with_interval(out.select(ident, "predicted_clv", "frequency", "recency", "monetary_value"), 0.2)


def predict_clv_heuristic(summary: DataFrame, ident: str, horizon: int = 365) -> DataFrame:
    """frequency / T * horizon * exp(-recency / 365) * monetary value; T <= 0 gives 0."""
    rate = F.when(F.col("T") > 0, F.col("frequency") / F.col("T")).otherwise(F.lit(0.0))
    clv = rate * horizon * F.exp(-F.col("recency") / 365) * F.col("monetary_value")
    out = summary.withColumn("predicted_clv", clv)
    return with_interval(out.select(ident, "predicted_clv", "frequency", "recency", "monetary_value"), 0.3)


def simple_clv(df: DataFrame, ident: str, monthly: str = "MonthlyCharges", tenure: str = "tenure") -> DataFrame:
    """Monthly charge times the expected remaining months, at least 6; interval -+20%."""
    clv = F.col(monthly) * F.greatest(24 - F.col(tenure), F.lit(6))
    return df.select(ident, F.greatest(clv, F.lit(0.0)).alias("predicted_clv"), (clv * 0.8).alias("clv_lower_ci"),
                     (clv * 1.2).alias("clv_upper_ci"))


def clv_totals(clv: DataFrame) -> DataFrame:
    """Mean, median and total of predicted values."""
    from retenta.plans.quantiles import fit_quantiles

    median = fit_quantiles(clv, ["predicted_clv"], [0.5])["predicted_clv"][0]
    return clv.agg(F.avg("predicted_clv").alias("mean_clv"), F.lit(median).alias("median_clv"), F.sum("predicted_clv").alias("total_clv"))


def fit_quality(spark, purchases: Fit, money: Fit | None) -> DataFrame:
    """(model, parameter, value, log_likelihood, aic): the fitted parameters with their likelihood."""
    rows = [("bgnbd", n, v, purchases.log_likelihood, purchases.aic) for n, v in zip(("r", "alpha", "a", "b"), purchases.params)]
    if money:
        rows += [("gamma_gamma", n, v, money.log_likelihood, money.aic) for n, v in zip(("p", "q", "v"), money.params)]
    return spark.createDataFrame(rows, "model string, parameter string, value double, log_likelihood double, aic double")
