"""Exact numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def rounded_mean(total, count, digits: int = 6) -> Column:
    """``total / count`` rounded half away from zero to ``digits`` decimals,
    computed on the exact integers (sum in decimal(38,0)), then one division
    by 10**digits. The result does not depend on summation order or on the
    engine's floating-point rounding; null when ``count`` is 0 or null.

    Exact (the double nearest to the rounded decimal) while |mean| * 10**digits
    < 2**53, i.e. |mean| < 9.0e9 at 6 digits; beyond that the scaled integer
    is itself rounded to a double first (identically in any IEEE engine)."""
    scale = 10 ** digits
    s = _c(total).cast("decimal(38,0)")
    n = _c(count).cast("decimal(38,0)")
    a = F.abs(s) * F.lit(2 * scale).cast("decimal(38,0)") + n
    b = n * F.lit(2).cast("decimal(38,0)")
    q = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    signed = F.when(s < 0, -q).otherwise(q)
    return F.when(n > 0, signed.cast("double") / F.lit(float(scale)))


def rounded_avg(value, digits: int = 6) -> Column:
    """Aggregate: exact mean of an integral column, rounded (see rounded_mean)."""
    v = _c(value)
    return rounded_mean(F.sum(v.cast("decimal(38,0)")), F.count(v), digits)
