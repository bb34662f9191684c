"""Tail probabilities for test statistics: Arrow functions over result rows (one per test)."""

from __future__ import annotations

import math
from bisect import bisect_left
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    # continued fraction, modified Lentz
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return min(1.0, front * h)


def _beta_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_reg(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or 1e-300)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + num * d or 1e-300)
            c = 1 + num / c or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi_square_tail(x: float, dof: float) -> float:
    return _gamma_upper(dof / 2, x / 2)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def correlation_tail(r: float, n: float) -> float:
    """Two-sided p of a correlation by the t approximation, n - 2 degrees of freedom."""
    dof = n - 2
    if dof <= 0:
        return float("nan")
    if abs(r) >= 1:
        return 0.0
    t2 = r * r * dof / (1 - r * r)
    return _beta_reg(dof / 2, 0.5, dof / (dof + t2))


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Sum of hypergeometric tables no likelier than the observed one."""
    r1, r2, c1, n = a + b, c + d, a + c, a + b + c + d

    def log_p(k: int) -> float:
        return (math.lgamma(r1 + 1) - math.lgamma(k + 1) - math.lgamma(r1 - k + 1)
                + math.lgamma(r2 + 1) - math.lgamma(c1 - k + 1) - math.lgamma(r2 - c1 + k + 1)
                - math.lgamma(n + 1) + math.lgamma(c1 + 1) + math.lgamma(n - c1 + 1))

    seen = log_p(a) + 1e-7
    mode = (r1 + 1) * (c1 + 1) // (n + 2)
    # probabilities fall on both sides of the mode: skip to the tails, leave them when terms vanish
    tails = (range(mode, min(r1, c1) + 1), range(mode - 1, max(0, c1 - r2) - 1, -1))

    def terms(ks: range):
        for i in range(bisect_left(ks, True, key=lambda k: log_p(k) <= seen), len(ks)):
            v = log_p(ks[i])
            if v < seen - 50:
                return
            yield math.exp(v)

    return min(1.0, math.fsum(x for ks in tails for x in terms(ks)))


@lru_cache
def _first_counts(small: int) -> tuple[int, list[int]]:
    """Period, and the number of partitions of at most m into parts 1..small for the first m."""
    period = math.lcm(*range(1, small + 1))
    counts = [1] * ((small + 1) * period)
    for part in range(1, small + 1):
        for m in range(part, len(counts)):
            counts[m] += counts[m - part]
    return period, counts


def _partitions_upto(m: int, small: int) -> int:
    """Partitions of at most m into parts 1..small: a polynomial on each residue, by Newton's differences."""
    if m < 0:
        return 0
    period, counts = _first_counts(small)
    steps, rest = divmod(m, period)
    ahead, total = counts[rest::period], 0
    for k in range(small + 1):
        total += math.comb(steps, k) * ahead[0]
        ahead = [y - x for x, y in zip(ahead, ahead[1:])]
    return total


def mann_whitney_exact(u: float, n1: int, n2: int) -> float:
    """Two-sided exact p without ties, in whole numbers.

    The arrangements with a given U are counted by the product of
    (1 - q^(large + i)) / (1 - q^i), i = 1..small, whose numerator has 2^small
    terms: the work depends on the smaller group alone.
    """
    small, large = min(n1, n2), max(n1, n2)
    low = math.floor(min(u, n1 * n2 - u))
    count = 0
    for size in range(small + 1):
        for chosen in combinations(range(1, small + 1), size):
            count += (-1) ** size * _partitions_upto(low - size * large - sum(chosen), small)
    return min(1.0, 2 * count / math.comb(small + large, small))


def _column(fn, *series: pd.Series) -> pd.Series:
    out = []
    for row in zip(*series):
        out.append(None if any(v is None or v != v for v in row) else fn(*row))
    return pd.Series(out, dtype="float64")


@F.pandas_udf(DoubleType())
def chi_square_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _column(chi_square_tail, x, dof)


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _column(normal_two_sided, z)


@F.pandas_udf(DoubleType())
def correlation_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return _column(correlation_tail, r, n)


@F.pandas_udf(DoubleType())
def fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return _column(lambda *v: fisher_two_sided(*(int(x) for x in v)), a, b, c, d)


@F.pandas_udf(DoubleType())
def mann_whitney_exact_p(u: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return _column(lambda u, a, b: mann_whitney_exact(float(u), int(a), int(b)), u, n1, n2)
