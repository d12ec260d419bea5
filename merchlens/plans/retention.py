"""Customer value and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.bands import frequency_tier, snapshot_tier
from merchlens.functions.money import currency, exact_round, mean_currency, pct, ratio
from merchlens.operators.customers import buyer_values, buyers_by_value, customer_ledger
from merchlens.operators.running import rows_between, running_by_value
from merchlens.operators.shares import share, total
from merchlens.params import Params
from merchlens.plans.marketing import customer_orders, mix_columns
from merchlens.sources.star import Star


def customer_portfolio_split(star: Star, params: Params) -> DataFrame:
    segment = (
        F.when(F.col("orders") == 0, "Never Purchased").when(F.col("orders") == 1, "One-Time").otherwise("Repeat (2+)")
    )
    return (
        customer_orders(star)
        .groupBy(segment.alias("segment"))
        .agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"), F.sum("net_c").alias("net_c"))
        .select(
            "segment",
            "customers",
            share(F.col("customers")).alias("pct_of_customers"),
            "orders",
            currency(F.col("net_c")).alias("order_net_revenue"),
            share(F.col("net_c")).alias("pct_of_revenue"),
        )
    )


def frequency_tier_value(star: Star, params: Params) -> DataFrame:
    return (
        customer_ledger(star)
        .groupBy(frequency_tier(F.col("orders")).alias("value_segment"))
        .agg(
            F.count("*").alias("customers"),
            F.sum("orders").alias("orders"),
            F.sum("net_c").alias("net_c"),
            F.sum("value_c").alias("value_c"),
        )
        .select(
            "value_segment",
            "customers",
            share(F.col("customers")).alias("pct_of_customers"),
            currency(F.col("value_c")).alias("net_revenue"),
            share(F.col("value_c")).alias("pct_of_net_revenue"),
            mean_currency(F.col("value_c"), F.col("customers")).alias("avg_clv_net"),
            exact_round(ratio(F.col("orders"), F.col("customers")), 2).alias("avg_orders"),
            mean_currency(F.col("net_c"), F.col("orders")).alias("aov"),
        )
    )


def value_deciles(star: Star, params: Params) -> DataFrame:
    """Buyers in ten groups by value; equal values may lie in two, and then count in each as often as they do."""
    values = running_by_value(buyer_values(star), [], "value_c", descending=True)
    # Sizes as NTILE has them: the first ones are larger by one.
    size, extra = F.floor(F.col("total_n") / 10), F.col("total_n") % 10

    def start(k: int) -> Column:
        return size * k + F.least(extra, F.lit(k))

    rows = [rows_between(start(k), start(k + 1)) for k in range(10)]
    sums = [
        F.struct(F.lit(k + 1).cast("bigint").alias("decile"), F.sum(r).alias("customers"), F.sum(r * F.col("value_c")).alias("value_c"))
        for k, r in enumerate(rows)
    ]
    # Ten rows from here on.
    deciles = values.agg(F.array(*sums).alias("s")).select(F.inline("s")).filter("customers > 0")
    so_far = F.sum("value_c").over(Window.orderBy("decile"))
    return deciles.select(
        "decile",
        "customers",
        currency(F.col("value_c")).alias("net_revenue"),
        share(F.col("value_c")).alias("pct_of_net_revenue"),
        pct(so_far, total(F.col("value_c"))).alias("cumulative_pct"),
    )


def repeat_vs_one_time(star: Star, params: Params) -> DataFrame:
    per = star.orders_by_customer()
    return (
        per.groupBy(F.when(F.col("orders") >= 2, "Repeat (2+)").otherwise("One-Time").alias("segment"))
        .agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"), F.sum("net_c").alias("net_c"))
        .select(
            "segment",
            "customers",
            F.col("orders").alias("total_orders"),
            currency(F.col("net_c")).alias("order_net_revenue"),
            share(F.col("net_c")).alias("pct_of_revenue"),
            mean_currency(F.col("net_c"), F.col("customers")).alias("avg_lifetime_revenue"),
            exact_round(ratio(F.col("orders"), F.col("customers")), 2).alias("avg_orders_per_customer"),
            mean_currency(F.col("net_c"), F.col("orders")).alias("aov"),
        )
    )


def snapshot_frequency_state(star: Star, params: Params) -> DataFrame:
    return (
        star.final_snapshot()
        .groupBy(snapshot_tier(F.col("cumulative_orders_to_date")).alias("frequency_tier"))
        .agg(
            F.count("*").alias("customers"),
            exact_round(ratio(F.sum("recency_days"), F.count("recency_days")), 0).alias("avg_recency_days"),
            F.count_if("is_active_flag").alias("active_customers"),
        )
        .select("*", pct(F.col("active_customers"), F.col("customers")).alias("active_pct"))
    )


def repeat_90d_rate(star: Star, params: Params) -> DataFrame:
    """Buyers whose second order date follows the first within 90 days.

    A second order on the first day does not count.
    """
    # A customer's distinct days are no more than the calendar's; the first two are kept.
    order = Window.partitionBy("customer_key").orderBy("order_date")
    days = (
        star.orders("customer_key", "order_date")
        .distinct()
        .withColumn("nth", F.row_number().over(order))
        .filter("nth <= 2")
        .groupBy("customer_key")
        .agg(F.min("order_date").alias("first_day"), F.max(F.when(F.col("nth") == 2, F.col("order_date"))).alias("second_day"))
    )
    gap = F.datediff("second_day", "first_day")
    return (
        days.agg(
            F.count("*").alias("customers_with_first_order"),
            F.count_if(gap <= params.repeat_days).alias("repeat_within_90d"),
        )
    ).select(
        "*", pct(F.col("repeat_within_90d"), F.col("customers_with_first_order")).alias("repeat_90d_rate_pct")
    )


def _high_value(rows: DataFrame, name: str) -> DataFrame:
    return (
        rows.groupBy(name)
        .agg(
            F.sum("top").alias("high_value_customers"),
            F.sum("buyers").alias("all_purchasers"),
        )
        .select("*", pct(F.col("high_value_customers"), F.col("all_purchasers")).alias("high_value_pct"))
    )


def _top_by(star: Star, attribute: str) -> DataFrame:
    return (
        buyers_by_value(star, attribute)
        .groupBy(attribute)
        .agg(F.count_if(F.col("decile") == 1).alias("top"), F.count("*").alias("buyers"))
    )


def high_value_by_region(star: Star, params: Params) -> DataFrame:
    geo = star.geography().select(F.col("geography_key").alias("home_geography_key"), "region")
    return _high_value(_top_by(star, "home_geography_key").join(geo, "home_geography_key"), "region")


def high_value_by_channel(star: Star, params: Params) -> DataFrame:
    names = star.marketing_channels().withColumnRenamed("marketing_channel_key", "acquisition_channel_key")
    rows = _top_by(star, "acquisition_channel_key").join(names, "acquisition_channel_key")
    return _high_value(rows, "channel_name")


def top_decile_group(label: str) -> Column:
    return F.when(F.col("decile") == 1, label).otherwise("Deciles 2-10").alias("customer_group")


def high_value_category_mix(star: Star, params: Params) -> DataFrame:
    groups = buyers_by_value(star).select("customer_key", top_decile_group("Top decile (high value)"))
    return (
        star.lines("customer_key", "product_key", "net_c")
        .join(star.products("product_key", "category"), "product_key")
        .groupBy("customer_key", "category")
        .agg(F.sum("net_c").alias("net_c"))
        .join(groups, "customer_key")
        .groupBy("customer_group", "category")
        .agg(F.sum("net_c").alias("net_c"))
        .groupBy("customer_group")
        .agg(*mix_columns(params))
    )
