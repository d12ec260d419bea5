"""Shares over an already grouped, small result."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from merchlens.functions.money import pct


def whole(aggregate: Column) -> Column:
    """An aggregate over all rows, for frames with one row per band, category,
    channel or region only."""
    return aggregate.over(Window.partitionBy())


def total(c: Column) -> Column:
    return whole(F.sum(c))


def share(c: Column, digits: int = 1) -> Column:
    return pct(c, total(c), digits)
