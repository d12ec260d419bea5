"""Bands over a number, and labels that several reports share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(x: Column, steps: Sequence[tuple[float, str]], last: str) -> Column:
    """The label of the first step whose bound lies above ``x``, else ``last``."""
    out = None
    for bound, label in steps:
        out = F.when(x < bound, label) if out is None else out.when(x < bound, label)
    return out.otherwise(last)


# Order-frequency tiers by number of orders.
FREQUENCY_TIERS = [(1, "0 - Never"), (2, "1 - One-time"), (4, "2-3 - Occasional"), (7, "4-6 - Regular")]
FREQUENCY_LAST = "7+ - Loyal"
SNAPSHOT_TIERS = [(1, "0 orders"), (2, "1 order"), (4, "2-3 orders"), (7, "4-6 orders")]
SNAPSHOT_LAST = "7+ orders"
# Bands of a customer's own return rate in percent.
RETURN_RATE_BANDS = [(20, "1-19%"), (40, "20-39%"), (60, "40-59%")]
RETURN_RATE_NONE = "0% - no returns"
RETURN_RATE_LAST = "60%+ - high-return cluster"
# Historical value classes, lowest first.
VALUE_CLASSES = ("1 Low", "2 Moderate", "3 High", "4 Elite")
CADENCE_BANDS = ("1 Fast", "2 Moderate", "3 Slow")
# Cohort maturity by observable months.
MATURITY_STEPS = [(3, "Immature"), (6, "Growing"), (12, "Established")]
MATURITY_LAST = "Fully Mature"


def frequency_tier(orders: Column) -> Column:
    return band(orders, FREQUENCY_TIERS, FREQUENCY_LAST)


def snapshot_tier(orders: Column) -> Column:
    return band(orders, SNAPSHOT_TIERS, SNAPSHOT_LAST)


def frequency_score(orders: Column) -> Column:
    """1 to 5 from the bands 1, 2-3, 4-6, 7-11, 12+."""
    return F.lit(1) + sum((orders >= low).cast("int") for low in (2, 4, 7, 12))


def value_class(value_c: Column, cuts_c: Sequence[int]) -> Column:
    return band(value_c, list(zip(cuts_c, VALUE_CLASSES)), VALUE_CLASSES[3])


def cadence_band(days: Column, cuts: Sequence[int]) -> Column:
    return band(days, list(zip(cuts, CADENCE_BANDS)), CADENCE_BANDS[2])


def maturity(months: Column) -> Column:
    return band(months, MATURITY_STEPS, MATURITY_LAST)


def quadrant(high_first: Column, high_second: Column, first: str, second: str) -> Column:
    return F.concat(
        F.when(high_first, "High ").otherwise("Low "),
        F.lit(first + " / "),
        F.when(high_second, "High ").otherwise("Low "),
        F.lit(second),
    )
