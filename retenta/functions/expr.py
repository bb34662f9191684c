"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def ratio(num: Column, den: Column, empty: float | None = None) -> Column:
    """num / den as double; `empty` (default NULL) when the divisor is 0 or NULL."""
    r = F.try_divide(num.cast("double"), den.cast("double"))
    return r if empty is None else F.coalesce(r, F.lit(float(empty)))


def cents(c: Column) -> Column:
    """Half-even rounding to two digits on the binary double, as array libraries do it."""
    return F.rint(c * 100) / F.lit(100.0)


def finite(c: Column) -> Column:
    """NaN becomes NULL: one missing marker throughout."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def clip(c: Column, low: Column | float, high: Column | float) -> Column:
    """Bounded value; NULL stays NULL (least/greatest alone would skip it)."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days from start to end (not calendar days)."""
    return F.timestamp_diff("DAY", start, end)


def elapsed_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def hash_key(seed: int | str, ident: Column) -> Column:
    """Reproducible pseudo-random hex text: the order used by every sampler."""
    return F.md5(F.concat(F.lit(f"{seed}|"), ident.cast("string")))


def hash_number(hex_text: Column) -> Column:
    """First 15 hex digits of a hash as a non-negative long; keeps the hex order."""
    return F.conv(F.substring(hex_text, 1, 15), 16, 10).cast("long")


def hash_uniform(hex_text: Column) -> Column:
    """Hash text as a double in [0, 1): its first 8 hex digits over 2^32."""
    return F.conv(F.substring(hex_text, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def thresholds_reached(thresholds: Sequence[float], score: Column) -> Column:
    """How many of the ascending thresholds are <= score, by a balanced literal tree."""

    def node(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(score >= F.lit(float(thresholds[mid])), node(mid + 1, hi)).otherwise(node(lo, mid))

    return node(0, len(thresholds))


def sample_skewness(n: Column, population: Column) -> Column:
    """Bias-corrected skewness from Spark's population value; NULL under 3 rows."""
    n = n.cast("double")
    return F.when(n > 2, population * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(n: Column, population: Column) -> Column:
    """Bias-corrected excess kurtosis from the population value; NULL under 4 rows."""
    n = n.cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * population + 6))


def labelled(pairs: dict[str, Column]) -> Column:
    """Array of (name, value) structs, ready to explode into long form."""
    return F.array(*[F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in pairs.items()])
