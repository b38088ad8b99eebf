"""Zero-guarded ratios and exact moment statistics.

Sums are kept exact (integers / decimals) and turned into doubles only for
the final division, so a mean is ``sum / count`` of exact totals and comes
out the same whatever order the partial sums were merged in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(c: Column) -> Column:
    return c.cast("double")


def safe_ratio(num: Column, den: Column, default: Column | float | None = None) -> Column:
    """``num / NULLIF(den, 0)`` in double; ``default`` replaces the NULL."""
    r = F.try_divide(as_double(num), as_double(F.nullif(den, F.lit(0))))
    if default is not None:
        r = F.coalesce(r, default if isinstance(default, Column) else F.lit(float(default)))
    return r


def mean(c: Column) -> Column:
    """AVG as exact sum over count (NULL when no value)."""
    return F.try_divide(as_double(F.sum(c)), as_double(F.count(c)))


def mean_of(total: Column, n: Column) -> Column:
    return F.try_divide(as_double(total), as_double(F.nullif(n, F.lit(0))))


def stddev_from_moments(n: Column, s1: Column, s2: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares.

    For integer-valued measures the moments are exact, so
    ``sqrt((n*s2 - s1^2) / (n*(n-1)))`` is evaluated on exact integers
    (DECIMAL(38,0), no overflow) and rounded once.  NULL for fewer than two
    values, like STDDEV_SAMP.
    """
    d = "decimal(38,0)"
    nn, a, b = n.cast(d), s1.cast(d), s2.cast(d)
    var = F.try_divide(as_double(nn * b - a * a), as_double(nn * (nn - F.lit(1))))
    return F.when(n >= 2, F.sqrt(var))
