"""The model-building jobs as tables of their own."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions.money import currency
from merchlens.operators import calendar as cal
from merchlens.operators import orders as ops
from merchlens.params import Params
from merchlens.session import scratch_path
from merchlens.sources.append import SNAPSHOT
from merchlens.sources.append import append_months as append
from merchlens.sources.publish import publish_table
from merchlens.sources.star import Star, StoredStar, read_star_table, stored_form, stored_snapshot


def calendar_dimension(star: Star, params: Params) -> DataFrame:
    return star.calendar()


def holiday_calendar(star: Star, params: Params) -> DataFrame:
    return cal.holiday_calendar(star.spark, star.calendar_start.year, star.horizon.year)


def campaign_windows(star: Star, params: Params) -> DataFrame:
    return star.campaigns().select(
        "campaign_key",
        "campaign_name",
        "campaign_type",
        "start_date",
        "end_date",
        "discount_depth",
        cal.depth_percent(F.col("discount_depth")).alias("discount_pct"),
        "season",
    )


def campaign_day_map(star: Star, params: Params) -> DataFrame:
    return cal.campaign_day_map(star.campaigns())


def campaign_attribution(star: Star, params: Params) -> DataFrame:
    days = cal.campaign_days(star.calendar(), star.campaigns())
    return ops.campaign_attribution(star.orders("order_key", "order_date", "gross_c"), days).select(
        "order_key",
        "order_date",
        "campaign_key",
        "discount_pct",
        currency(F.col("gross_c")).alias("gross_revenue"),
        currency(F.col("campaign_discount_c")).alias("campaign_discount"),
    )


def order_header_rollup(star: Star, params: Params) -> DataFrame:
    """Headers summed from lines, with shipping and the first-order flag."""
    return star.orders(
        "order_key", "customer_key", "order_date", "gross_c", "discount_c", "net_c", "shipping_c", "is_first_order"
    ).select(
        "order_key",
        "customer_key",
        "order_date",
        currency(F.col("gross_c")).alias("gross_revenue"),
        currency(F.col("discount_c")).alias("discount_amount"),
        currency(F.col("net_c")).alias("net_revenue"),
        currency(F.col("shipping_c")).alias("shipping_revenue"),
        "is_first_order",
    )


def discount_allocation(star: Star, params: Params) -> DataFrame:
    """The campaign discount of each order spread over its lines.

    A line's campaign follows from its order's date, so lines get their percent
    without meeting the headers.
    """
    days = cal.campaign_days(star.calendar(), star.campaigns())
    lines = ops.campaign_attribution(star.lines("order_key", "order_line_key", "order_date", "gross_c"), days)
    return ops.discount_allocation(lines, ["order_line_key"]).select(
        "order_line_key",
        "order_key",
        currency(F.col("gross_c")).alias("gross_line_revenue"),
        currency(F.col("line_discount_c")).alias("line_discount"),
        currency(F.col("line_net_c")).alias("net_line_revenue"),
    )


def refund_proration(star: Star, params: Params) -> DataFrame:
    return star.returns(
        "return_key", "order_key", "product_key", "return_date", "return_reason_key", "return_quantity",
        "refund_c", "fee_c", "refund_completed_flag",
    ).select(
        "return_key",
        "order_key",
        "product_key",
        "return_date",
        "return_reason_key",
        "return_quantity",
        currency(F.col("refund_c")).alias("return_amount"),
        currency(F.col("fee_c")).alias("restocking_fee"),
        "refund_completed_flag",
    )


def customer_monthly_snapshot(star: Star, params: Params) -> DataFrame:
    rows = star.snapshot()
    return rows.select(
        *[c for c in rows.columns if not c.endswith("_c")],
        currency(F.col("cumulative_net_c")).alias("cumulative_net_revenue_to_date"),
        currency(F.col("rolling_12mo_c")).alias("rolling_12mo_net_revenue"),
    )


def append_months(star: Star, params: Params) -> DataFrame:
    """Publish the snapshot up to a quarter before the horizon, append the months since, and read it all back."""
    root = scratch_path(star.spark, "append")
    since = (star.horizon.replace(day=1) - dt.timedelta(days=63)).replace(day=1)
    publish_table(stored_snapshot(star.snapshot().filter(F.col("month_end") < F.lit(since))), root, SNAPSHOT)
    append(star, root, since)
    rows = StoredStar(star.spark, root).snapshot()
    return rows.select(
        *[c for c in rows.columns if not c.endswith("_c")],
        currency(F.col("cumulative_net_c")).alias("cumulative_net_revenue_to_date"),
        currency(F.col("rolling_12mo_c")).alias("rolling_12mo_net_revenue"),
    )


def publish_orders(star: Star, params: Params) -> DataFrame:
    """Publish the order fact, read it back from where it was put."""
    root = scratch_path(star.spark, "publish")
    publish_table(stored_form(star, "fact_orders"), root, "fact_orders")
    return read_star_table(star.spark, root, "fact_orders").select(
        "order_key",
        "order_id",
        "customer_key",
        "order_date_key",
        "campaign_key",
        *[F.col(c).cast("double").alias(c) for c in ("gross_revenue", "discount_amount", "net_revenue")],
        "is_first_order",
    )


def read_returns_csv(star: Star, params: Params) -> DataFrame:
    """Publish the returns fact as CSV and read it with its declared types."""
    root = scratch_path(star.spark, "csv")
    publish_table(stored_form(star, "fact_returns"), root, "fact_returns", fmt="csv")
    return read_star_table(star.spark, root, "fact_returns", fmt="csv").select(
        "return_key",
        "order_line_key",
        "return_date_key",
        "return_reason_key",
        "return_quantity",
        *[F.col(c).cast("double").alias(c) for c in ("return_amount", "restocking_fee")],
        "refund_completed_flag",
    )


# The calendar and campaign tables above read no table but the span of order dates, so they are
# functions for a star, and no queries of their own.
JOBS = {
    "campaign_attribution": campaign_attribution,
    "order_header_rollup": order_header_rollup,
    "discount_allocation": discount_allocation,
    "refund_proration": refund_proration,
    "customer_monthly_snapshot": customer_monthly_snapshot,
    "append_months": append_months,
    "publish_table": publish_orders,
    "read_star_table": read_returns_csv,
}
