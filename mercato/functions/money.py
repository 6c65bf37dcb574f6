"""Money aggregates that keep every digit.

A value is split into whole cents (``rint(x * 100)``, a long) and the rest,
which is exactly 0.0 for amounts in cents. Longs are summed exactly, whatever
the partitioning, and stay in generated code; the rests are summed as doubles
and added at the end, so amounts below a cent are not lost. NaN counts as
missing, as a data frame library skips it. Beyond 9e13 a value is all rest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Below this, cents are exact in a double.
MOST_CENTS = 9e13


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def present(column) -> Column:
    """The value as double; NaN becomes NULL."""
    return F.nanvl(_c(column).cast("double"), F.lit(None).cast("double"))


def cents(column) -> Column:
    """Whole cents of an amount (long)."""
    v = present(column)
    return F.when(F.abs(v) < MOST_CENTS, F.rint(v * F.lit(100.0))).when(v.isNotNull(), F.lit(0.0)).cast("long")


def from_cents(column) -> Column:
    """Integer cents -> money double (the double nearest the exact value)."""
    return _c(column).cast("double") / F.lit(100.0)


def money_sum(column) -> Column:
    """Sum as double: exact for amounts in cents. NULL when all are missing."""
    v = present(column)
    return from_cents(F.sum(cents(v))) + F.sum(v - from_cents(cents(v)))


def money_avg(column) -> Column:
    """money_sum over the number of values that are not missing."""
    return F.try_divide(money_sum(column), F.count(present(column)))


def avg_exact(column) -> Column:
    """Average of an integer column (sum is exact in double below 2**53)."""
    c = _c(column)
    return F.try_divide(F.sum(c).cast("double"), F.count(c))
