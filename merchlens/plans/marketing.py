"""Acquisition channels and campaigns.

The acquisition channel is a lifetime attribute of the customer, and returns
carry no campaign, so campaign revenue is before returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.bands import quadrant
from merchlens.functions.money import currency, exact_round, mean_currency, pct, ratio
from merchlens.operators.shares import share, total, whole
from merchlens.params import Params
from merchlens.sources.star import Star


def customer_orders(star: Star, *attributes: str) -> DataFrame:
    """Every customer with the number and net amount of its orders."""
    return (
        star.customers("customer_key", *attributes)
        .join(star.orders_by_customer(), "customer_key", "left")
        .fillna(0, ["orders", "net_c"])
    )


def _channels(star: Star) -> DataFrame:
    """One row per acquisition channel key with its base, buyers and sales."""
    return (
        customer_orders(star, "acquisition_channel_key")
        .groupBy("acquisition_channel_key")
        .agg(
            F.count("*").alias("customers"),
            F.count_if(F.col("orders") >= 1).alias("buyers"),
            F.count_if(F.col("orders") >= 2).alias("repeaters"),
            F.sum("orders").alias("orders"),
            F.sum("net_c").alias("net_c"),
        )
        .join(
            star.marketing_channels().withColumnRenamed("marketing_channel_key", "acquisition_channel_key"),
            "acquisition_channel_key",
        )
    )


def _rpc() -> Column:
    return mean_currency(F.col("net_c"), F.col("customers"))


def channel_volume(star: Star, params: Params) -> DataFrame:
    rows = _channels(star).groupBy("channel_name", "channel_category").agg(
        *[F.sum(c).alias(c) for c in ("customers", "buyers", "orders", "net_c")]
    )
    return rows.select(
        "channel_name",
        "channel_category",
        F.col("customers").alias("customers_acquired"),
        F.col("buyers").alias("purchasing_customers"),
        "orders",
        currency(F.col("net_c")).alias("order_net_revenue"),
        share(F.col("net_c")).alias("pct_of_revenue"),
        share(F.col("customers")).alias("pct_of_customers"),
    )


def channel_customer_quality(star: Star, params: Params) -> DataFrame:
    return _channels(star).select(
        "channel_name",
        F.col("customers").alias("acquired_customers"),
        _rpc().alias("revenue_per_customer"),
        pct(F.col("repeaters"), F.col("customers")).alias("repeat_rate_pct"),
        mean_currency(F.col("net_c"), F.col("orders")).alias("aov"),
        exact_round(ratio(F.col("orders"), F.col("buyers")), 2).alias("orders_per_purchasing_customer"),
    )


def campaign_type_performance(star: Star, params: Params) -> DataFrame:
    per_campaign = (
        star.orders("campaign_key", "net_c")
        .filter("campaign_key is not null")
        .groupBy("campaign_key")
        .agg(F.count("*").alias("orders"), F.sum("net_c").alias("net_c"))
    )
    return (
        per_campaign.join(star.campaigns().select("campaign_key", "campaign_type"), "campaign_key")
        .groupBy("campaign_type")
        .agg(F.sum("orders").alias("orders"), F.sum("net_c").alias("net_c"))
        .select(
            "campaign_type",
            "orders",
            currency(F.col("net_c")).alias("campaign_revenue_gross"),
            mean_currency(F.col("net_c"), F.col("orders")).alias("aov"),
            share(F.col("net_c")).alias("pct_of_campaign_revenue"),
        )
    )


def channel_value_vs_volume(star: Star, params: Params) -> DataFrame:
    value = 100.0 * ratio(F.col("net_c"), total(F.col("net_c")))
    volume = 100.0 * ratio(F.col("customers"), total(F.col("customers")))
    return _channels(star).select(
        "channel_name",
        "channel_category",
        exact_round(volume, 1).alias("customer_share_pct"),
        exact_round(value, 1).alias("revenue_share_pct"),
        exact_round(value - volume, 1).alias("value_vs_volume_gap"),
        _rpc().alias("revenue_per_customer"),
        pct(F.col("repeaters"), F.col("customers")).alias("repeat_rate_pct"),
    )


def channel_mix_by_region(star: Star, params: Params) -> DataFrame:
    per = (
        star.customers("home_geography_key", "acquisition_channel_key")
        .groupBy("home_geography_key", "acquisition_channel_key")
        .agg(F.count("*").alias("customers"))
    )
    geo = star.geography().select(F.col("geography_key").alias("home_geography_key"), "region")
    names = star.marketing_channels().select(
        F.col("marketing_channel_key").alias("acquisition_channel_key"), "channel_name"
    )
    rows = (
        per.join(geo, "home_geography_key")
        .join(names, "acquisition_channel_key")
        .groupBy("region", "channel_name")
        .agg(F.sum("customers").alias("customers"))
    )
    in_region = F.sum("customers").over(Window.partitionBy("region"))
    return rows.select(
        "region", "channel_name", "customers", pct(F.col("customers"), in_region).alias("pct_of_region")
    )


def mix_columns(params: Params) -> list[Column]:
    """Share of each listed category in the net amount, over a grouped frame."""

    def of(category: str) -> Column:
        return F.sum(F.when(F.col("category") == category, F.col("net_c")).otherwise(0))

    return [
        pct(of(c), F.sum("net_c")).alias(f"category_{i}_pct")
        for i, c in enumerate(params.mix_categories, start=1)
    ]


def category_mix_by_channel(star: Star, params: Params) -> DataFrame:
    who = star.customers("customer_key", "acquisition_channel_key")
    names = star.marketing_channels().select(
        F.col("marketing_channel_key").alias("acquisition_channel_key"), "channel_name"
    )
    per = (
        star.lines("customer_key", "product_key", "net_c")
        .join(star.products("product_key", "category"), "product_key")
        .groupBy("customer_key", "category")
        .agg(F.sum("net_c").alias("net_c"))
        .join(who, "customer_key")
        .groupBy("acquisition_channel_key", "category")
        .agg(F.sum("net_c").alias("net_c"))
    )
    return (
        per.join(names, "acquisition_channel_key")
        .groupBy("channel_name")
        .agg(*mix_columns(params), currency(F.sum("net_c")).alias("channel_category_revenue"))
    )


def channel_quadrants(star: Star, params: Params) -> DataFrame:
    national = ratio(total(F.col("net_c")), total(F.col("customers")))
    rows = _channels(star).select(
        "*",
        ratio(F.col("net_c"), F.col("customers")).alias("rpc"),
        national.alias("national"),
        whole(F.median("customers")).alias("median_customers"),
    )
    return rows.select(
        "channel_name",
        "customers",
        _rpc().alias("revenue_per_customer"),
        pct(F.col("rpc"), F.col("national")).alias("rpc_index"),
        quadrant(
            F.col("customers") >= F.col("median_customers"), F.col("rpc") >= F.col("national"), "Volume", "Value"
        ).alias("portfolio_quadrant"),
    )
