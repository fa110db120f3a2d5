"""Rounded statistics that give the same digits on every run and engine.

Money is carried as integer cents and star ratings as integer tenths, so
sums are exact whatever the order rows arrive in.  A statistic divides once,
at the end, and rounds half up: ``floor(num * mul / den + 1/2) / div``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(x, scale: int = 1) -> Column:
    """Round a double to ``1/scale`` steps, halves upward."""
    return F.floor(col(x) * F.lit(float(scale)) + 0.5) / F.lit(float(scale))


def rounded(num, den, mul: int = 1, div: int = 1) -> Column:
    """``num * mul / den`` rounded half up, then divided by ``div``; null on a zero denominator."""
    quotient = F.try_divide((col(num) * mul).cast("double"), col(den))
    return F.floor(quotient + 0.5) / F.lit(float(div))


def safe_ratio(a, b, scale: int | None = None) -> Column:
    """``a / b``, null when ``b`` is zero, optionally rounded to ``1/scale``."""
    quotient = F.try_divide(col(a).cast("double"), col(b))
    return quotient if scale is None else half_up(quotient, scale)


def floor_ratio(a, b, floor: int = 1, scale: int = 100) -> Column:
    """``a / greatest(b, floor)`` rounded to ``1/scale``."""
    return rounded(a, F.greatest(col(b), F.lit(floor)), scale, scale)


def units(c, per_unit: int = 100) -> Column:
    """Integer minor units (cents, tenths) as a plain number."""
    return col(c) / F.lit(float(per_unit))


def minor(c, per_unit: int = 100) -> Column:
    """The inverse of :func:`units`: back to exact integers before summing."""
    return F.round(col(c) * F.lit(float(per_unit))).cast("long")


# ---- aggregates -----------------------------------------------------------

def sum_if(cond, c) -> Column:
    return F.sum(F.when(cond, col(c)))


def count_if(cond) -> Column:
    return F.count_if(cond)


def mean(c, mul: int, div: int, where=None) -> Column:
    """Rounded mean of an integer column; ``where`` restricts it to some rows."""
    picked = col(c) if where is None else F.when(where, col(c))
    return rounded(F.sum(picked), F.count(picked), mul, div)


def money_mean(c, where=None) -> Column:
    """Mean of a cents column, in units with two decimals."""
    return mean(c, 1, 100, where)


def rating_mean(c, where=None) -> Column:
    """Mean of a tenths column, two decimals."""
    return mean(c, 10, 100, where)


def count_mean(c, where=None) -> Column:
    """Mean of a whole-number column, one decimal."""
    return mean(c, 10, 10, where)


def avg_if(cond, c, mul: int = 100, div: int = 100) -> Column:
    return mean(c, mul, div, cond)


def pct(cond, dp: int = 1) -> Column:
    """Share of the group's rows that meet ``cond``, in percent."""
    return rounded(F.count_if(cond), F.count(F.lit(1)), 100 * 10**dp, 10**dp)


def pct_of(cond, base, dp: int = 1) -> Column:
    """Share of the rows meeting ``base`` that also meet ``cond``, in percent."""
    return rounded(F.count_if(base & cond), F.count_if(base), 100 * 10**dp, 10**dp)


def pct_sum(c, dp: int = 1) -> Column:
    """Share of rows flagged by a 0/1 column, in percent."""
    return rounded(F.sum(col(c)), F.count(F.lit(1)), 100 * 10**dp, 10**dp)


def total_money(c) -> Column:
    return units(F.sum(col(c)))


def rated(c, per_unit: int) -> Column:
    """Mean of an already rounded column, at the column's own precision.  The
    values return to integers first so the sum does not depend on row order."""
    return rounded(F.sum(minor(c, per_unit)), F.count(col(c)), 1, per_unit)


def weighted_mean(value, weight) -> Column:
    return F.try_divide(F.sum(col(value) * col(weight)), F.sum(col(weight)).cast("double"))
