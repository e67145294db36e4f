"""Number helpers whose results do not depend on row order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact amount. Sums of decimals are exact, so they are the same whatever the shuffle order."""
    return _col(c).cast(MONEY)


def no_nan(c) -> Column:
    """NaN means missing in the raw files; Spark would sort it above every number."""
    return F.when(F.isnan(_col(c)), F.lit(None)).otherwise(_col(c))


def dbl(c) -> Column:
    return _col(c).cast("double")


def big(c) -> Column:
    return _col(c).cast("bigint")


def ratio(num, den) -> Column:
    """Double quotient; NULL instead of an ANSI error on a zero divisor."""
    return F.try_divide(dbl(num), dbl(den))


def percent(num, den) -> Column:
    return F.try_divide(F.lit(100.0) * dbl(num), dbl(den))


def round_half_up(c, digits: int) -> Column:
    """``floor(x * 10^n + 0.5) / 10^n``: one definition of ties for every engine."""
    scale = float(10**digits)
    return F.floor(dbl(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def mean(total, count, digits: int | None = None) -> Column:
    """Mean from an exact total and a count."""
    out = ratio(total, count)
    return out if digits is None else round_half_up(out, digits)


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def sample_skewness(c) -> Column:
    """Bias-corrected skewness: population g1 times ``sqrt(n(n-1)) / (n-2)``; 0 for constant data."""
    n = F.count(_col(c)).cast("double")
    g1 = F.coalesce(F.skewness(dbl(c)), F.lit(0.0))
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))
