"""Product and category profitability, returns and positioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.bands import quadrant
from merchlens.functions.money import currency, exact_round, mean_currency, pct, ratio
from merchlens.operators.shares import share, total, whole
from merchlens.params import Params
from merchlens.sources.star import Star


def _profit() -> Column:
    return F.col("net_c") - F.col("cost_c")


def category_totals(star: Star) -> DataFrame:
    return (
        star.product_totals("category")
        .groupBy("category")
        .agg(F.sum("units").alias("units"), F.sum("net_c").alias("net_c"), F.sum("cost_c").alias("cost_c"))
    )


def category_returns(star: Star) -> DataFrame:
    return (
        star.product_returns("category")
        .groupBy("category")
        .agg(F.sum("units_returned").alias("units_returned"), F.sum("refund_c").alias("refund_c"))
    )


def _with_returns(star: Star) -> DataFrame:
    return (
        category_totals(star)
        .join(category_returns(star), "category", "left")
        .fillna(0, ["units_returned", "refund_c"])
    )


def category_profitability(star: Star, params: Params) -> DataFrame:
    return category_totals(star).select(
        "category",
        currency(F.col("net_c")).alias("revenue"),
        currency(F.col("cost_c")).alias("cogs"),
        currency(_profit()).alias("gross_profit"),
        pct(_profit(), F.col("net_c")).alias("gross_margin_pct"),
        share(_profit()).alias("profit_contribution_pct"),
    )


def _products(star: Star, order: Column, limit: int = 15) -> DataFrame:
    return (
        star.product_totals("product_name", "category")
        .withColumn("profit_c", _profit())
        .orderBy(order, "product_key")
        .limit(limit)
        .select(
            "product_key",
            "product_name",
            "category",
            F.col("units").alias("units_sold"),
            currency(F.col("net_c")).alias("revenue"),
            currency(F.col("profit_c")).alias("gross_profit"),
            pct(F.col("profit_c"), F.col("net_c")).alias("margin_pct"),
        )
    )


def top_products_by_profit(star: Star, params: Params) -> DataFrame:
    return _products(star, F.desc("profit_c"))


def bottom_products_by_profit(star: Star, params: Params) -> DataFrame:
    return _products(star, F.asc("profit_c"))


def category_return_performance(star: Star, params: Params) -> DataFrame:
    return _with_returns(star).select(
        "category",
        F.col("units").alias("units_sold"),
        "units_returned",
        pct(F.col("units_returned"), F.col("units")).alias("return_rate_pct"),
        currency(F.col("refund_c")).alias("revenue_returned"),
        pct(F.col("refund_c"), F.col("net_c")).alias("pct_revenue_returned"),
    )


def category_value_divergence(star: Star, params: Params) -> DataFrame:
    """Ranks by revenue, by profit, and by profit less the margin on refunds."""
    margin = ratio(_profit(), F.col("net_c"))
    rows = _with_returns(star).withColumn(
        "adjusted", currency(_profit()) - currency(F.col("refund_c")) * margin
    )

    def rank(c: Column) -> Column:
        return F.rank().over(Window.orderBy(c.desc())).cast("bigint")

    return rows.select(
        "category",
        currency(F.col("net_c")).alias("revenue"),
        rank(F.col("net_c")).alias("revenue_rank"),
        currency(_profit()).alias("gross_profit"),
        rank(_profit()).alias("profit_rank"),
        pct(_profit(), F.col("net_c")).alias("margin_pct"),
        pct(F.col("units_returned"), F.col("units")).alias("return_rate_pct"),
        exact_round(F.col("adjusted"), 2).alias("returns_adjusted_profit"),
        rank(F.col("adjusted")).alias("adjusted_profit_rank"),
    )


def category_premium_volume(star: Star, params: Params) -> DataFrame:
    price, overall = ratio(F.col("net_c"), F.col("units")), ratio(total(F.col("net_c")), total(F.col("units")))
    rows = category_totals(star).select(
        "*", price.alias("price"), overall.alias("overall"), whole(F.avg("units")).alias("mean_units")
    )
    dear, few = F.col("price") >= F.col("overall"), F.col("units") < F.col("mean_units")
    cheap, many = F.col("price") < F.col("overall"), F.col("units") > F.col("mean_units")
    return rows.select(
        "category",
        mean_currency(F.col("net_c"), F.col("units")).alias("avg_unit_price"),
        F.col("units").alias("units_sold"),
        exact_round(F.col("overall") / 100, 2).alias("portfolio_avg_price"),
        F.when(dear & few, "PREMIUM").when(cheap & many, "VOLUME").otherwise("BALANCED").alias("classification"),
    )


def category_quadrants(star: Star, params: Params) -> DataFrame:
    """Revenue against the median category, margin against the blended margin."""
    blended = ratio(total(_profit()), total(F.col("net_c")))
    rows = category_totals(star).select(
        "*",
        whole(F.median("net_c")).alias("median_c"),
        (ratio(_profit(), F.col("net_c")) >= blended).alias("rich"),
    )
    return rows.select(
        "category",
        currency(F.col("net_c")).alias("revenue"),
        pct(_profit(), F.col("net_c")).alias("margin_pct"),
        quadrant(F.col("net_c") >= F.col("median_c"), F.col("rich"), "Revenue", "Margin").alias(
            "portfolio_quadrant"
        ),
    )
