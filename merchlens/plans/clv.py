"""Historical customer lifetime value over the full base."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions.bands import value_class
from merchlens.functions.money import currency, exact_round, mean_currency
from merchlens.operators import customers as cust
from merchlens.operators.selection import grouped_quantiles
from merchlens.operators.shares import share
from merchlens.params import Params
from merchlens.session import stage
from merchlens.sources.star import Star

NON_BUYER, ZERO_NET, POSITIVE = "1 Non-purchaser", "2 Zero-net buyer", "3 Positive Historical CLV"


def historical_clv(star: Star, params: Params) -> DataFrame:
    return cust.historical_clv(star).select(
        "customer_key", "lifetime_orders", currency(F.col("clv_c")).alias("historical_clv")
    )


def clv_value_tiers(star: Star, params: Params) -> DataFrame:
    tier = F.when(F.col("lifetime_orders") == 0, NON_BUYER).when(F.col("clv_c") == 0, ZERO_NET).otherwise(POSITIVE)
    return (
        cust.historical_clv(star)
        .groupBy(tier.alias("value_tier"))
        .agg(F.count("*").alias("customers"), F.sum("clv_c").alias("clv_c"))
        .select(
            "value_tier",
            "customers",
            share(F.col("customers")).alias("pct_of_base"),
            currency(F.col("clv_c")).alias("total_historical_clv"),
            share(F.col("clv_c")).alias("pct_of_total_clv"),
        )
    )


def _positive(star: Star) -> DataFrame:
    return (
        cust.buyer_totals(star)
        .select("customer_key", (F.col("net_c") - F.col("refund_c")).alias("clv_c"))
        .filter("clv_c > 0")
    )


def clv_percentiles(star: Star, params: Params) -> DataFrame:
    rows = stage(_positive(star), "clv")
    points = {"p25": 0.25, "median_clv": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}
    q = grouped_quantiles(
        rows.withColumn("basis", F.lit("all")),
        ["basis"],
        {"clv": F.col("clv_c") / 100},
        {name: ("clv", p) for name, p in points.items()},
    )
    totals = rows.groupBy(F.lit("all").alias("basis")).agg(
        F.count("*").alias("positive_clv_customers"), F.sum("clv_c").alias("clv_c"), F.max("clv_c").alias("max_c")
    )
    return totals.join(q, "basis").select(
        "positive_clv_customers",
        *[exact_round(F.col(name), 2).alias(name) for name in points],
        mean_currency(F.col("clv_c"), F.col("positive_clv_customers")).alias("mean_clv_context_only"),
        currency(F.col("max_c")).alias("max_clv"),
    )


def clv_value_classes(star: Star, params: Params) -> DataFrame:
    return (
        _positive(star)
        .groupBy(value_class(F.col("clv_c"), params.value_cuts_c).alias("historical_value_class"))
        .agg(F.count("*").alias("customers"), F.sum("clv_c").alias("clv_c"))
        .select(
            "historical_value_class",
            "customers",
            share(F.col("customers")).alias("pct_of_positive"),
            mean_currency(F.col("clv_c"), F.col("customers")).alias("avg_historical_clv"),
            currency(F.col("clv_c")).alias("total_historical_clv"),
            share(F.col("clv_c")).alias("pct_of_positive_clv"),
        )
    )


def clv_by_rfm_segment(star: Star, params: Params) -> DataFrame:
    """A buyer's monetary value at the final snapshot is the lifetime value."""
    cust.hold_buyer_totals(star)
    values = cust.buyer_totals(star).select("customer_key", (F.col("net_c") - F.col("refund_c")).alias("clv_c"))
    rows = stage(
        cust.rfm_segments(star, money=False).select("customer_key", "segment").join(values, "customer_key"), "segment-clv"
    )
    q = grouped_quantiles(
        rows, ["segment"], {"clv": F.col("clv_c") / 100}, {"median": ("clv", 0.5)}
    )
    return (
        rows.groupBy("segment")
        .agg(F.count("*").alias("customers"), F.sum("clv_c").alias("clv_c"))
        .join(q, "segment")
        .select(
            "segment",
            "customers",
            mean_currency(F.col("clv_c"), F.col("customers")).alias("avg_historical_clv"),
            exact_round(F.col("median"), 2).alias("median_historical_clv"),
            currency(F.col("clv_c")).alias("total_historical_clv"),
            share(F.col("clv_c")).alias("portfolio_clv_share_pct"),
        )
    )
