"""Date columns shared by the calendar, the snapshot and the cohorts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_of_key(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_index(d: Column) -> Column:
    """Months since year 0; differences count month boundaries, not whole months."""
    return (F.year(d) * 12 + F.month(d) - 1).cast("int")


def month_end_of_index(idx: Column) -> Column:
    return F.last_day(F.make_date(F.floor(idx / 12).cast("int"), (idx % 12 + 1).cast("int"), F.lit(1)))


def iso_weekday(d: Column) -> Column:
    return F.weekday(d) + 1


def season(d: Column) -> Column:
    quarter = F.floor((F.month(d) % 12) / 3)
    return F.element_at(
        F.array(*[F.lit(s) for s in ("Winter", "Spring", "Summer", "Fall")]), quarter.cast("int") + 1
    )


def first_weekday_from(d: Column, weekday: str) -> Column:
    """The first given weekday on or after ``d``."""
    return F.next_day(F.date_sub(d, 1), weekday)


def last_weekday_of_month(d: Column, weekday: str) -> Column:
    return F.next_day(F.date_sub(F.last_day(d), 7), weekday)


def span_of_years(years: Iterable[int]) -> tuple[dt.date, dt.date]:
    """The first and last day of the years and those between them."""
    years = list(years)
    return dt.date(min(years), 1, 1), dt.date(max(years), 12, 31)
