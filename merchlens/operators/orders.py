"""Order-level transforms: attribution, header roll-up, discount split, refunds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.money import half_up_percent, half_up_share

# Free shipping from this net amount, else the flat fee.
FREE_SHIPPING_FROM_C = 7500
SHIPPING_FEE_C = 699
# Restocking fee in percent, the reason it applies to, and the
# days a refund takes.
RESTOCKING_PERCENT = 10
RESTOCKING_REASON_KEY = 4
REFUND_DAYS = 5


def campaign_attribution(orders: DataFrame, day_map: DataFrame) -> DataFrame:
    """Add campaign_key, discount_pct and the discount that campaign gives.

    The day map has at most one row per calendar day, so it is broadcast.
    """
    days = day_map.select(F.col("full_date").alias("order_date"), "campaign_key", "discount_pct")
    return (
        orders.join(F.broadcast(days), "order_date", "left")
        .withColumn("discount_pct", F.coalesce("discount_pct", F.lit(0)))
        .withColumn("campaign_discount_c", half_up_percent(F.col("gross_c"), F.col("discount_pct")))
    )


def shipping(net_c: Column) -> Column:
    return F.when(net_c >= FREE_SHIPPING_FROM_C, 0).otherwise(SHIPPING_FEE_C).cast("bigint")


def first_order_flag(orders: DataFrame) -> DataFrame:
    """Flag each customer's earliest order (lowest key on that day).

    The first orders are found by a map-side aggregate and joined back on the
    order key, so a customer with very many orders makes no large group.
    """
    firsts = (
        orders.groupBy("customer_key")
        .agg(F.min(F.struct("order_date", "order_key")).alias("f"))
        .select(F.col("f.order_key").alias("order_key"), F.lit(True).alias("_first"))
    )
    return (
        orders.join(firsts, "order_key", "left")
        .withColumn("is_first_order", F.coalesce("_first", F.lit(False)))
        .drop("_first")
    )


def discount_allocation(lines: DataFrame, line_order: list[str]) -> DataFrame:
    """Spread each order's discount over its lines.

    The order's discount is ``discount_pct`` of its gross, rounded once. Every
    line takes that percent of its own gross, rounded; the last line in
    ``line_order`` also takes the remainder, so the lines sum to the order.
    ``lines``: order_key, gross_c, discount_pct (the same on all lines of an
    order) and the ``line_order`` columns, which tell its lines apart. One
    aggregate per order replaces a running sum, so no order has to be sorted in
    one task.
    """
    percent = F.col("discount_pct")
    own = lines.withColumn("_own", half_up_percent(F.col("gross_c"), percent))
    per_order = own.groupBy("order_key").agg(
        F.sum("gross_c").alias("_gross"),
        F.max("discount_pct").alias("_pct"),
        F.sum("_own").alias("_given"),
        F.max(F.struct(*line_order)).alias("_last"),
    )
    rest = per_order.select(
        "order_key",
        "_last",
        (half_up_percent(F.col("_gross"), F.col("_pct")) - F.col("_given")).alias("_rest"),
    )
    is_last = F.struct(*line_order) == F.col("_last")
    return (
        own.join(rest, "order_key")
        .withColumn("line_discount_c", F.col("_own") + F.when(is_last, F.col("_rest")).otherwise(0))
        .withColumn("line_net_c", F.col("gross_c") - F.col("line_discount_c"))
        .drop("_own", "_rest", "_last")
    )


def refund(net_c: Column, returned: Column, sold: Column) -> Column:
    """The share of a line's net amount that its returned units carry."""
    return half_up_share(net_c, returned, sold)


def restocking_fee(refund_c: Column, reason_key: Column) -> Column:
    fee = half_up_percent(refund_c, F.lit(RESTOCKING_PERCENT))
    return F.when(reason_key == RESTOCKING_REASON_KEY, fee).otherwise(F.lit(0)).cast("bigint")


def refund_completed(return_date: Column, horizon: Column) -> Column:
    return F.datediff(horizon, return_date) >= REFUND_DAYS
