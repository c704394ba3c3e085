"""Numeric expressions: rate clamps, rounding and age bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daycast.functions.dates import ColumnOrName, _c

# Age-bin edges in years (left-closed) and their labels.
AGE_BREAKS = (0, 1, 5, 10, 15, 20, 30, 50, 100)
AGE_LABELS = ("<1", "1-5", "5-10", "10-15", "15-20", "20-30", "30-50", "50+")


def clamp(x: ColumnOrName, low: ColumnOrName, high: ColumnOrName) -> Column:
    """least(greatest(x, low), high): if low > high the result is high."""
    return F.least(F.greatest(_c(x), _c(low)), _c(high))


def monthly_rate(annual: ColumnOrName) -> Column:
    """Twelfth root of an annual growth factor."""
    return F.pow(_c(annual), F.lit(1.0 / 12.0))


def age_years(age_months: ColumnOrName) -> Column:
    """K8: age in years to one decimal, rounding half to even."""
    return F.bround(_c(age_months) / F.lit(12.0), 1)


def age_group(years: ColumnOrName) -> Column:
    """K9: left-closed bins over AGE_BREAKS; null outside [0, 100) and for null."""
    y = _c(years)
    expr = None
    for lo, hi, label in zip(AGE_BREAKS[:-1], AGE_BREAKS[1:], AGE_LABELS):
        cond = (y >= lo) & (y < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
