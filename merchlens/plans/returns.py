"""Returns and where value leaks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions.bands import (
    RETURN_RATE_BANDS,
    RETURN_RATE_LAST,
    RETURN_RATE_NONE,
    band,
    frequency_tier,
)
from merchlens.functions.money import currency, exact_round, pct, ratio
from merchlens.operators.customers import buyer_totals, buyers_by_value, customer_ledger
from merchlens.operators.shares import share, total
from merchlens.params import Params
from merchlens.plans.retention import top_decile_group
from merchlens.sources.star import Star


def returns_overview(star: Star, params: Params) -> DataFrame:
    sold = star.orders("net_c").agg(F.sum("net_c").alias("net_c")).scalar()
    return (
        star.returns("return_quantity", "refund_c", "fee_c")
        .agg(
            F.count("*").alias("total_returns"),
            F.sum("return_quantity").alias("units_returned"),
            F.sum("refund_c").alias("refund_c"),
            F.sum("fee_c").alias("fee_c"),
        )
        .select(
            "total_returns",
            "units_returned",
            currency(F.col("refund_c")).alias("revenue_refunded"),
            currency(F.col("fee_c")).alias("restocking_recovered"),
            currency(F.col("refund_c") - F.col("fee_c")).alias("net_revenue_leakage"),
            pct(F.col("refund_c"), sold).alias("refund_pct_of_order_net_rev"),
        )
    )


def _by_reason(star: Star) -> DataFrame:
    per = (
        star.returns("return_reason_key", "return_quantity", "refund_c")
        .groupBy("return_reason_key")
        .agg(
            F.count("*").alias("returns"),
            F.sum("return_quantity").alias("units"),
            F.sum("refund_c").alias("refund_c"),
        )
    )
    return per.join(star.return_reasons(), "return_reason_key")


def return_reasons(star: Star, params: Params) -> DataFrame:
    return _by_reason(star).select(
        "reason_description",
        "is_controllable",
        "returns",
        "units",
        currency(F.col("refund_c")).alias("revenue_returned"),
        share(F.col("refund_c")).alias("pct_of_returned_value"),
    )


def return_controllability(star: Star, params: Params) -> DataFrame:
    return (
        _by_reason(star)
        .groupBy("is_controllable")
        .agg(F.sum("refund_c").alias("refund_c"))
        .select(
            "is_controllable",
            currency(F.col("refund_c")).alias("revenue_returned"),
            share(F.col("refund_c")).alias("pct_of_returned_value"),
        )
    )


def category_return_drivers(star: Star, params: Params) -> DataFrame:
    """Return rate per category and the share of refunds one named reason causes."""
    sold = (
        star.lines("product_key", "quantity")
        .groupBy("product_key")
        .agg(F.sum("quantity").alias("units"))
        .join(star.products("product_key", "category"), "product_key")
        .groupBy("category")
        .agg(F.sum("units").alias("units"))
    )
    back = (
        star.returns("product_key", "return_reason_key", "return_quantity", "refund_c")
        .groupBy("product_key", "return_reason_key")
        .agg(F.sum("return_quantity").alias("units_returned"), F.sum("refund_c").alias("refund_c"))
        .join(star.products("product_key", "category"), "product_key")
        .groupBy("category", "return_reason_key")
        .agg(F.sum("units_returned").alias("units_returned"), F.sum("refund_c").alias("refund_c"))
        .join(star.return_reasons().select("return_reason_key", "reason_description"), "return_reason_key")
    )
    named = F.when(F.col("reason_description") == params.driver_reason, F.col("refund_c")).otherwise(0)
    per = back.groupBy("category").agg(
        F.sum("units_returned").alias("units_returned"),
        F.sum("refund_c").alias("refund_c"),
        F.sum(named).alias("named_c"),
    )
    return sold.join(per, "category").select(
        "category",
        pct(F.col("units_returned"), F.col("units")).alias("return_rate_pct"),
        currency(F.col("refund_c")).alias("revenue_returned"),
        pct(F.col("named_c"), F.col("refund_c")).alias("named_reason_pct_of_returns"),
    )


def return_rate_by_frequency(star: Star, params: Params) -> DataFrame:
    return (
        customer_ledger(star)
        .groupBy(frequency_tier(F.col("orders")).alias("value_segment"))
        .agg(
            F.count("*").alias("customers"),
            pct(F.sum("units_returned"), F.sum("units")).alias("return_rate_pct"),
            currency(F.sum("refund_c")).alias("revenue_returned"),
        )
    )


def return_rate_bands(star: Star, params: Params) -> DataFrame:
    rate = 100.0 * ratio(F.col("units_returned"), F.col("units"))
    label = F.when(F.col("units_returned") == 0, RETURN_RATE_NONE).otherwise(
        band(rate, RETURN_RATE_BANDS, RETURN_RATE_LAST)
    )
    return (
        buyer_totals(star)
        .groupBy(label.alias("return_rate_band"))
        .agg(F.count("*").alias("customers"))
        .select("*", share(F.col("customers")).alias("pct_of_purchasers"))
    )


def top_decile_net_of_returns(star: Star, params: Params) -> DataFrame:
    return (
        buyers_by_value(star)
        .groupBy(top_decile_group("Top decile"))
        .agg(F.count("*").alias("customers"), F.sum("net_c").alias("net_c"), F.sum("value_c").alias("value_c"))
        .select(
            "customer_group",
            "customers",
            currency(F.col("net_c")).alias("gross_value"),
            currency(F.col("value_c")).alias("net_value_after_returns"),
            pct(F.col("net_c") - F.col("value_c"), F.col("net_c")).alias("pct_lost_to_returns"),
        )
    )


def _rate_by(star: Star, attribute: str) -> DataFrame:
    return (
        customer_ledger(star, attribute)
        .groupBy(attribute)
        .agg(F.sum("units").alias("units"), F.sum("units_returned").alias("units_returned"))
    )


def _rate(rows: DataFrame, name: str) -> DataFrame:
    sums = rows.groupBy(name).agg(F.sum("units").alias("units"), F.sum("units_returned").alias("units_returned"))
    return sums.filter("units_returned > 0").select(
        name, pct(F.col("units_returned"), F.col("units")).alias("return_rate_pct"), "units_returned"
    )


def region_return_rate(star: Star, params: Params) -> DataFrame:
    geo = star.geography().select(F.col("geography_key").alias("home_geography_key"), "region")
    return _rate(_rate_by(star, "home_geography_key").join(geo, "home_geography_key"), "region")


def channel_return_rate(star: Star, params: Params) -> DataFrame:
    names = star.marketing_channels().withColumnRenamed("marketing_channel_key", "acquisition_channel_key")
    return _rate(_rate_by(star, "acquisition_channel_key").join(names, "acquisition_channel_key"), "channel_name")


def value_leakage_ranked(star: Star, params: Params) -> DataFrame:
    """Five leakage sources. The opportunity cost is modelled, so it takes no
    part in the realised shares."""
    reasons = _by_reason(star).agg(
        F.sum(F.when(F.col("is_controllable"), F.col("refund_c")).otherwise(0)).alias("ours"),
        F.sum(F.when(~F.col("is_controllable"), F.col("refund_c")).otherwise(0)).alias("theirs"),
    )
    discounts = star.orders("discount_c").agg(F.sum("discount_c").alias("discount_c"))
    per = star.orders_by_customer()
    once, again = F.col("orders") == 1, F.col("orders") >= 2
    gap = F.avg(F.when(again, F.col("net_c"))) - F.avg(F.when(once, F.col("net_c")))
    opportunity = per.agg(exact_round(gap * F.count_if(once) / 100, 2).alias("dollars"))
    rows = [
        reasons.select(F.lit("Returns - controllable"), F.lit("Realized"), currency(F.col("ours"))),
        reasons.select(F.lit("Returns - non-controllable"), F.lit("Realized"), currency(F.col("theirs"))),
        discounts.select(F.lit("Discounts given"), F.lit("Realized"), currency(F.col("discount_c"))),
        discounts.select(F.lit("Never-purchased customers"), F.lit("Realized"), F.lit(0.0)),
        opportunity.select(F.lit("One-time customers - opportunity cost"), F.lit("Opportunity"), "dollars"),
    ]
    leaks = reduce(
        DataFrame.union, [r.toDF("leakage_source", "leakage_class", "dollars") for r in rows]
    )
    real = F.when(F.col("leakage_class") == "Realized", F.col("dollars"))
    return leaks.select("*", pct(real, total(real)).alias("pct_of_realized_leakage")).orderBy(
        F.col("leakage_class") == "Opportunity", F.desc("dollars")
    )
