"""Order-independent sums and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Double sums change with the partitioning, so stored totals and reconciliation
# add fixed-point values instead; six places keep a nanosecond of a millisecond.
FIXED_POINT = "decimal(28,6)"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fixed(value: Column | str) -> Column:
    return col(value).cast(FIXED_POINT)


def exact_sum(value: Column | str) -> Column:
    return F.sum(fixed(value)).cast("double")


def exact_mean(value: Column | str) -> Column:
    return ratio(exact_sum(value), F.count(col(value)))


def ratio(numerator: Column | str, denominator: Column | str, scale: float = 1.0) -> Column:
    """``scale * n / d``; NULL when the denominator is zero."""
    top = col(numerator).cast("double")
    if scale != 1.0:
        top = F.lit(float(scale)) * top
    return F.try_divide(top, col(denominator).cast("double"))


def count_true(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def at_least_zero(value: Column | str) -> Column:
    """Clamp below at zero; NULL stays NULL."""
    return F.when(col(value) < 0, F.lit(0.0)).otherwise(col(value).cast("double"))


def clamp(value: Column | str, low: float, high: float) -> Column:
    checked = col(value)
    return F.when(checked.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), checked)))

