"""Money and rounding.

The numerator is scaled while it is still an exact integer or decimal, so that there is one floating-point
division only and a half is hit exactly. Results then do not depend on how rows were split over tasks.
"""

from pyspark.sql import Column, functions as F

# Amounts up to 10**18; sums of them, times 100, still fit a decimal.
MONEY = "decimal(20,2)"


def money(name: str) -> Column:
    """The amount to the cent, rounded half up; null where the source number is NaN, infinite or does not fit."""
    return F.col(name).try_cast(MONEY)


def unreadable_money(name: str) -> Column:
    """True where there is a number but :func:`money` cannot hold it."""
    return F.col(name).isNotNull() & money(name).isNull()


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``numerator / denominator`` rounded half up to ``digits``; null when the denominator is 0 or null."""
    scale = 10**digits
    quotient = F.try_divide((numerator * F.lit(scale)).cast("double"), denominator.cast("double"))
    return F.round(quotient, 0) / F.lit(scale)


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` with 2 decimals."""
    return rounded_ratio(part * F.lit(100), whole)


def count_true(flag: Column) -> Column:
    """Number of true flags; null when every flag of the group is null."""
    return F.sum(flag.cast("int"))
