"""Holidays, campaign windows, the day map they give, and the calendar table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlens.functions.dates import (
    date_key,
    first_weekday_from,
    iso_weekday,
    last_weekday_of_month,
    season,
)
from merchlens.operators.interval_join import interval_join

# Seven campaign windows a year. Windows without a start day hang
# on Thanksgiving (fourth Thursday of November), by days after it.
_WINDOWS = [
    # name, type, discount depth, (start month, day), (end month, day), days after Thanksgiving
    ("Spring Collection Launch", "Seasonal Launch", "None", (2, 15), (3, 15), None),
    ("Summer Sale", "Promotional Sale", "Moderate", (7, 5), (7, 25), None),
    ("Back-to-School", "Promotional Sale", "Moderate", (8, 1), (8, 21), None),
    ("Black Friday", "Promotional Sale", "Deep", None, None, (1, 3)),
    ("Cyber Monday", "Promotional Sale", "Deep", None, None, (4, 4)),
    ("Holiday Collection", "Seasonal Launch", "Light", (11, 15), (12, 24), None),
    ("January Clearance", "Clearance", "Deepest", (1, 2), (1, 21), None),
]
# Percent off per discount depth.
DEPTH_PERCENT = {"None": 0, "Light": 10, "Moderate": 20, "Deep": 30, "Deepest": 45}
TARGET_AUDIENCE = "All Customers"


def _years(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))


def _day(month: int, day: int) -> Column:
    return F.make_date(F.col("year"), F.lit(month), F.lit(day))


def thanksgiving() -> Column:
    """Fourth Thursday of November of the column ``year``."""
    return F.date_add(first_weekday_from(_day(11, 1), "Thu"), 21)


def holiday_calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """(full_date, holiday_name): seven retail holidays a year."""
    days = {
        "New Year's Day": _day(1, 1),
        "Memorial Day": last_weekday_of_month(_day(5, 1), "Mon"),
        "Independence Day": _day(7, 4),
        "Labor Day": first_weekday_from(_day(9, 1), "Mon"),
        "Thanksgiving": thanksgiving(),
        "Black Friday": F.date_add(thanksgiving(), 1),
        "Christmas Day": _day(12, 25),
    }
    rows = F.array(*[F.struct(d.alias("full_date"), F.lit(n).alias("holiday_name")) for n, d in days.items()])
    return _years(spark, first_year, last_year).select(F.inline(rows))


def campaign_windows(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per campaign instance; keys run 1..N by year and window."""
    structs = []
    for i, (name, kind, depth, start, end, after) in enumerate(_WINDOWS, start=1):
        first = _day(*start) if start else F.date_add(thanksgiving(), after[0])
        final = _day(*end) if end else F.date_add(thanksgiving(), after[1])
        structs.append(
            F.struct(
                ((F.col("year") - first_year) * len(_WINDOWS) + i).cast("int").alias("campaign_key"),
                F.concat_ws(" ", F.lit(name), F.col("year")).alias("campaign_name"),
                F.lit(kind).alias("campaign_type"),
                first.alias("start_date"),
                final.alias("end_date"),
                F.lit(depth).alias("discount_depth"),
                season(first).alias("season"),
                F.lit(TARGET_AUDIENCE).alias("target_audience"),
                F.lit(True).alias("is_active_flag"),
            )
        )
    return _years(spark, first_year, last_year).select(F.inline(F.array(*structs)))


def depth_percent(depth: Column) -> Column:
    pairs = [F.lit(v) for kv in DEPTH_PERCENT.items() for v in kv]
    return F.element_at(F.create_map(*pairs), depth)


def campaign_days(days: DataFrame, campaigns: DataFrame) -> DataFrame:
    """(full_date, campaign_key, discount_depth, discount_pct): the days (``full_date``, each once) that lie in a
    campaign's window.

    Where windows overlap the deepest discount wins, then the lower key.
    """
    spans = campaigns.select(
        "campaign_key", "discount_depth", depth_percent(F.col("discount_depth")).alias("discount_pct"), "start_date", "end_date"
    )
    held = interval_join(days.select("full_date"), spans, "full_date", "start_date", "end_date").drop("start_date", "end_date")
    return _best_per_day(held)


def campaign_day_map(campaigns: DataFrame) -> DataFrame:
    """As ``campaign_days``, for every day of any window, without a list of days."""
    days = campaigns.select(
        F.explode(F.sequence("start_date", "end_date")).alias("full_date"),
        "campaign_key",
        "discount_depth",
        depth_percent(F.col("discount_depth")).alias("discount_pct"),
    )
    return _best_per_day(days)


def _best_per_day(days: DataFrame) -> DataFrame:
    # As many rows to a day as campaigns run on it.
    best = Window.partitionBy("full_date").orderBy(F.desc("discount_pct"), "campaign_key")
    return days.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")


def calendar_dimension(
    spark: SparkSession, start: dt.date, end: dt.date, holidays: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """One row per day from ``start`` to ``end``. The fiscal year is the calendar year."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    covered = campaigns.select(F.explode(F.sequence("start_date", "end_date")).alias("full_date")).distinct()
    d = F.col("full_date")
    # The calendar has one row per day, so both flag lists are a few thousand rows at most.
    return (
        days.join(F.broadcast(holidays.select("full_date", F.lit(True).alias("_h"))), "full_date", "left")
        .join(F.broadcast(covered.withColumn("_c", F.lit(True))), "full_date", "left")
        .select(
            date_key(d).alias("date_key"),
            d,
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.weekofyear(d).alias("week_of_year"),
            iso_weekday(d).alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_name"),
            (iso_weekday(d) >= 6).alias("is_weekend"),
            F.coalesce("_h", F.lit(False)).alias("holiday_flag"),
            F.quarter(d).alias("fiscal_quarter"),
            F.year(d).alias("fiscal_year"),
            season(d).alias("season"),
            F.coalesce("_c", F.lit(False)).alias("campaign_period_flag"),
        )
    )
