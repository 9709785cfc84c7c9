"""Price labels such as ``Budget (< 15K)``."""

from pyspark.sql import Column, functions as F

# Label words, bounds in rupees, and the pattern of the tier name.
BUDGET, MID_RANGE, PREMIUM = "Budget", "Mid-range", "Premium"
LOWER_BOUND, UPPER_BOUND = 15000, 40000
TIER_PATTERN = r"^(\w[\w\-]*)"


def price_bounds(name: str) -> tuple[Column, Column]:
    """(lowest, highest) price of a label. Premium has no highest price.

    Null and unknown labels count as mid-range; :func:`price_range_known` tells them apart.
    """
    label = F.col(name)
    budget = label.contains(BUDGET)
    premium = label.contains(PREMIUM)
    lowest = F.when(budget, 0).when(premium, UPPER_BOUND).otherwise(LOWER_BOUND)
    highest = F.when(budget, LOWER_BOUND).when(~F.coalesce(premium, F.lit(False)), UPPER_BOUND)
    return lowest, highest


def price_tier(name: str) -> Column:
    """The leading word of the label; empty when the label does not start with one."""
    return F.regexp_extract(name, TIER_PATTERN, 1)


def price_range_known(name: str) -> Column:
    label = F.col(name)
    known = label.contains(BUDGET) | label.contains(MID_RANGE) | label.contains(PREMIUM)
    return F.coalesce(known, F.lit(False))
