"""Buying behaviour, compared within equal order frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.money import currency, exact_round, mean_currency, pct, ratio
from merchlens.operators import customers as cust
from merchlens.operators.selection import grouped_quantiles
from merchlens.params import Params
from merchlens.session import stage
from merchlens.sources.star import Star

POPULATION = "Positive Historical CLV"
EXCLUDED_ZERO = "Excluded - zero-net buyers"
EXCLUDED_NONE = "Excluded - non-purchasers"
BASE = "Customer base"


def behavioral_features(star: Star, params: Params) -> DataFrame:
    return (
        cust.behavioral_features(star, params)
        .withColumn("historical_clv", currency(F.col("clv_c")))
        .withColumn("purchase_cadence_days", exact_round(F.col("purchase_cadence_days"), 4))
        .drop("clv_c")
    )


def behavior_population(star: Star, params: Params) -> DataFrame:
    value, orders = F.col("clv_c"), F.col("lifetime_orders")
    counts = cust.historical_clv(star).agg(
        F.count_if(value > 0).alias(POPULATION),
        F.count_if((value == 0) & (orders > 0)).alias(EXCLUDED_ZERO),
        F.count_if(orders == 0).alias(EXCLUDED_NONE),
        F.count("*").alias(BASE),
    )
    return counts.unpivot([], counts.columns, "population", "customers")


def _reliability(params: Params) -> Column:
    return F.when(F.col("customers") < params.min_cell, "LOW_BASE").otherwise("RELIABLE").alias("cell_reliability")


def _few(column: str, p: float) -> Column:
    """Percentile of a column with few distinct values: the built-in one is fine."""
    return F.percentile(column, p)


def behavior_by_value_class(star: Star, params: Params) -> DataFrame:
    rows = stage(cust.behavioral_features(star, params), "features")
    q = grouped_quantiles(
        rows,
        ["historical_value_class"],
        {"cadence": F.col("purchase_cadence_days")},
        {"c50": ("cadence", 0.5), "c25": ("cadence", 0.25), "c75": ("cadence", 0.75)},
    )
    few = rows.groupBy("historical_value_class").agg(
        F.count("*").alias("customers"),
        _few("order_frequency", 0.5).alias("median_order_frequency_control"),
        _few("category_breadth", 0.5).alias("median_category_breadth"),
        exact_round(_few("category_breadth", 0.25), 1).alias("cat_breadth_p25"),
        exact_round(_few("category_breadth", 0.75), 1).alias("cat_breadth_p75"),
        _few("channel_breadth", 0.5).alias("median_channel_breadth"),
    )
    return few.join(q, "historical_value_class", "left").select(
        *few.columns,
        exact_round(F.col("c50"), 0).alias("median_cadence_days"),
        exact_round(F.col("c25"), 0).alias("cadence_p25"),
        exact_round(F.col("c75"), 0).alias("cadence_p75"),
    )


def _cells(rows: DataFrame, by: str, params: Params) -> DataFrame:
    """Size, median and mean value of each (order frequency, ``by``) cell."""
    rows = stage(rows.select("customer_key", "order_frequency", by, "clv_c"), "cells")
    cell = ["order_frequency", by]
    q = grouped_quantiles(rows, cell, {"clv": F.col("clv_c") / 100}, {"median": ("clv", 0.5)})
    sizes = rows.groupBy(*cell).agg(F.count("*").alias("customers"), F.sum("clv_c").alias("clv_c"))
    return sizes.join(q, cell).select(
        F.col("order_frequency").alias("order_frequency_stratum"),
        by,
        "customers",
        exact_round(F.col("median"), 2).alias("median_historical_clv"),
        mean_currency(F.col("clv_c"), F.col("customers")).alias("mean_historical_clv"),
        _reliability(params),
    )


def breadth_controlled(star: Star, params: Params) -> DataFrame:
    rows = cust.behavioral_features(star, params).filter(F.col("order_frequency").isin(*params.breadth_strata))
    return _cells(rows, "category_breadth", params)


def channel_breadth_controlled(star: Star, params: Params) -> DataFrame:
    rows = cust.behavioral_features(star, params).filter(F.col("order_frequency").isin(*params.control_strata))
    return _cells(rows, "channel_breadth", params).drop("mean_historical_clv")


def cadence_controlled(star: Star, params: Params) -> DataFrame:
    rows = (
        cust.behavioral_features(star, params)
        .filter(F.col("order_frequency").isin(*params.control_strata))
        .filter("purchase_cadence_days is not null")
        .withColumn("cadence_band", cust.cadence_of(params))
    )
    return _cells(rows, "cadence_band", params).drop("mean_historical_clv")


def non_explanatory_variables(star: Star, params: Params) -> DataFrame:
    """Basket, return rate and discount share, which do not set classes apart."""
    rows = stage(
        cust.buyer_totals(star)
        .withColumn("clv_c", F.col("net_c") - F.col("refund_c"))
        .filter("clv_c > 0")
        .select(
            "customer_key",
            cust.value_class(F.col("clv_c"), params.value_cuts_c).alias("historical_value_class"),
            "units",
            "units_returned",
            (ratio(F.col("net_c"), F.col("orders")) / 100).alias("basket"),
            (100.0 * ratio(F.col("discount_c"), F.col("gross_c"))).alias("discount_share"),
        ),
        "baskets",
    )
    q = grouped_quantiles(
        rows,
        ["historical_value_class"],
        {"basket": F.col("basket"), "discount": F.col("discount_share")},
        {"basket": ("basket", 0.5), "discount": ("discount", 0.5)},
    )
    sums = rows.groupBy("historical_value_class").agg(
        F.count("*").alias("customers"), F.sum("units").alias("units"), F.sum("units_returned").alias("back")
    )
    return sums.join(q, "historical_value_class").select(
        "historical_value_class",
        "customers",
        exact_round(F.col("basket"), 2).alias("median_basket_value"),
        pct(F.col("back"), F.col("units")).alias("return_rate_pct"),
        exact_round(F.col("discount"), 1).alias("median_discount_share_pct"),
    )


def behavior_by_rfm_segment(star: Star, params: Params) -> DataFrame:
    cust.hold_buyer_totals(star, breadth=True)
    segments = cust.rfm_segments(star, money=False).select("customer_key", "segment")
    rows = stage(cust.behavioral_features(star, params).join(segments, "customer_key"), "segment-features")
    q = grouped_quantiles(
        rows, ["segment"], {"cadence": F.col("purchase_cadence_days")}, {"c50": ("cadence", 0.5)}
    )
    few = rows.groupBy("segment").agg(
        F.count("*").alias("customers"),
        _few("category_breadth", 0.5).alias("median_category_breadth"),
        _few("channel_breadth", 0.5).alias("median_channel_breadth"),
    )
    return few.join(q, "segment", "left").select(
        *few.columns, exact_round(F.col("c50"), 0).alias("median_cadence_days")
    )
