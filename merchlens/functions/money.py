"""Exact money and ratio columns.

Money is carried as whole cents in BIGINT: sums are exact, need no decimal
objects in the aggregation buffers, and do not depend on row order. It turns
into currency units only in the last projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Whole cents of a DOUBLE amount that has at most two decimals."""
    return F.round(amount * 100).cast("bigint")


def cents_of_decimal(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def decimal_of(amount_c: Column, precision: int = 12) -> Column:
    return (amount_c.cast("decimal(20,0)") / 100).cast(f"decimal({precision},2)")


def currency(amount_c: Column) -> Column:
    return amount_c.cast("double") / F.lit(100.0)


def int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def half_up_share(total_c: Column, part: Column, whole: Column) -> Column:
    """``total * part / whole`` rounded half up to a cent, in integers."""
    return int_div(total_c * part * 2 + whole, whole * 2)


def half_up_percent(total_c: Column, percent: Column) -> Column:
    return half_up_share(total_c, percent.cast("bigint"), F.lit(100).cast("bigint"))


def exact_round(x: Column, digits: int) -> Column:
    """Round half up on the decimal value, not on its binary image."""
    return F.round(x.cast("decimal(28,6)"), digits).cast("double")


def ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    return exact_round(F.lit(100.0) * ratio(num, den), digits)


def mean_currency(total_c: Column, count: Column, digits: int = 2) -> Column:
    return exact_round(ratio(total_c, count) / 100, digits)
