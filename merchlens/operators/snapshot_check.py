"""A second derivation of the snapshot, to compare the first one with.

It keeps the dense month table the other way avoids: monthly sums are joined to
every customer month and a twelve-row frame gives the trailing year.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.dates import month_index
from merchlens.operators.interval_join import interval_join


def dense_snapshot(customers: DataFrame, orders: DataFrame, returns: DataFrame, horizon: dt.date) -> DataFrame:
    """customer_key, month_end and the measures that events decide.

    For events not before the signup month, which the integrity checks assert.

    Events shrink to customers' days and months, which are dealt out by customer before anything is unfolded; the joins
    and windows below take them as they are in a job that is lean (``session.stage``). A customer with very many orders
    is no more than their days.
    """
    customers = customers.select("customer_key", "signup_date").repartition("customer_key")
    days = (
        orders.groupBy("customer_key", "order_date")
        .agg(F.count("*").alias("n"), F.sum("net_c").alias("net_c"))
        .repartition("customer_key")
    )
    spine = customers.select(
        "customer_key",
        "signup_date",
        F.explode(
            F.sequence(F.trunc("signup_date", "MM"), F.trunc(F.lit(horizon), "MM"), F.expr("interval 1 month"))
        ).alias("month"),
    )
    sold = days.groupBy("customer_key", F.trunc("order_date", "MM").alias("month")).agg(
        F.sum("n").alias("n"), F.sum("net_c").alias("net_c"), F.max("order_date").alias("last")
    )
    back = (
        returns.groupBy("customer_key", F.trunc("return_date", "MM").alias("month"))
        .agg(F.sum("refund_c").alias("refund_c"))
        .repartition("customer_key")
    )
    # Each order counts in the month ends of the 90 days from its own.
    spans = days.select(
        "customer_key",
        "order_date",
        "n",
        month_index(F.col("order_date")).alias("first_m"),
        month_index(F.date_add("order_date", 89)).alias("last_m"),
    )
    months = spine.select("customer_key", "month", month_index(F.col("month")).alias("m"))
    age = F.datediff(F.last_day("month"), "order_date")
    near = (
        interval_join(months, spans, "m", "first_m", "last_m", ["customer_key"], both_large=True)
        .filter(age < 90)
        .groupBy("customer_key", "month")
        .agg(F.sum(F.when(age < 30, F.col("n")).otherwise(0)).alias("n30"), F.sum("n").alias("n90"))
    )
    key = ["customer_key", "month"]
    dense = spine.join(sold, key, "left").join(back, key, "left").join(near, key, "left")
    gain = F.coalesce("net_c", F.lit(0)) - F.coalesce("refund_c", F.lit(0))
    by = Window.partitionBy("customer_key").orderBy("month")
    to_date, year = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(-11, 0)
    recency = F.datediff("month_end", "last")
    return dense.select(
        "customer_key",
        F.last_day("month").alias("month_end"),
        F.datediff(F.last_day("month"), "signup_date").alias("customer_age_days"),
        F.last("last", ignorenulls=True).over(to_date).alias("last"),
        F.coalesce("n30", F.lit(0)).alias("orders_last_30_days"),
        F.coalesce("n90", F.lit(0)).alias("orders_last_90_days"),
        F.coalesce(F.sum("n").over(to_date), F.lit(0)).alias("cumulative_orders_to_date"),
        F.sum(gain).over(to_date).alias("cumulative_net_c"),
        F.sum(gain).over(year).alias("rolling_12mo_c"),
    ).select("*", recency.alias("recency_days")).drop("last")
