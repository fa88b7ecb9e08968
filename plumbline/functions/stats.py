"""Aggregate expressions that ignore missing values and never divide by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import safe_ratio


def pair_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both sides are present; null if flat."""
    x_seen = F.when(y.isNotNull(), x)
    y_seen = F.when(x.isNotNull(), y)
    return safe_ratio(F.covar_pop(x, y), F.stddev_pop(x_seen) * F.stddev_pop(y_seen))


def pair_count(x: Column, y: Column) -> Column:
    return F.count(F.when(x.isNotNull() & y.isNotNull(), F.lit(1)))


def digit(code: Column, base: int, place: int) -> Column:
    """Digit of a non-negative integer at ``base ** place``."""
    return F.pmod(F.floor(code / F.lit(base**place)), F.lit(base)).cast("int")
