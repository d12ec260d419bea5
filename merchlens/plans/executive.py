"""Headline KPIs. Each total is taken at its own grain; none joins header to line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.money import currency, mean_currency, pct
from merchlens.params import Params
from merchlens.sources.star import Star


def _header_totals(star: Star) -> DataFrame:
    return star.orders("gross_c", "discount_c", "net_c").agg(
        F.count("*").alias("total_orders"),
        F.sum("gross_c").alias("gross_c"),
        F.sum("discount_c").alias("discount_c"),
        F.sum("net_c").alias("net_c"),
    )


def _margin_totals(star: Star) -> DataFrame:
    return star.product_totals().agg(
        F.sum("units").alias("units"), F.sum("net_c").alias("line_net_c"), F.sum("cost_c").alias("cost_c")
    )


def _return_totals(star: Star) -> DataFrame:
    return star.returns("refund_c", "return_quantity").agg(
        F.sum("refund_c").alias("refund_c"), F.sum("return_quantity").alias("units_returned")
    )


def _customer_totals(star: Star) -> DataFrame:
    return star.customers("customer_key").agg(F.count("*").alias("total_customers"))


def _repeat_totals(star: Star) -> DataFrame:
    per = star.orders("customer_key").groupBy("customer_key").agg(F.count("*").alias("n"))
    return per.agg(F.count_if(F.col("n") >= 2).alias("repeat_customers"))


def _scalar(one_row: DataFrame, column: str) -> Column:
    return one_row.select(column).scalar()


def _margin() -> Column:
    return pct(F.col("line_net_c") - F.col("cost_c"), F.col("line_net_c"), 2)


def kpi_order_net_revenue(star: Star, params: Params) -> DataFrame:
    return star.orders("net_c").agg(currency(F.sum("net_c")).alias("order_net_revenue"))


def kpi_net_revenue(star: Star, params: Params) -> DataFrame:
    refunds = _scalar(_return_totals(star), "refund_c")
    return (
        star.orders("net_c")
        .agg(F.sum("net_c").alias("net_c"))
        .select(currency(F.col("net_c") - F.coalesce(refunds, F.lit(0))).alias("net_revenue"))
    )


def kpi_gross_margin_pct(star: Star, params: Params) -> DataFrame:
    return _margin_totals(star).select(_margin().alias("gross_margin_pct"))


def kpi_aov(star: Star, params: Params) -> DataFrame:
    return star.orders("net_c").agg(mean_currency(F.sum("net_c"), F.count("*")).alias("avg_order_value"))


def kpi_discount_impact_pct(star: Star, params: Params) -> DataFrame:
    return _header_totals(star).select(pct(F.col("discount_c"), F.col("gross_c"), 2).alias("discount_impact_pct"))


def kpi_return_rate_pct(star: Star, params: Params) -> DataFrame:
    sold = _scalar(star.lines("quantity").agg(F.sum("quantity").alias("units")), "units")
    return _return_totals(star).select(pct(F.col("units_returned"), sold, 2).alias("return_rate_pct"))


def kpi_repeat_purchase_rate_pct(star: Star, params: Params) -> DataFrame:
    base = _scalar(_customer_totals(star), "total_customers")
    return _repeat_totals(star).select(
        pct(F.col("repeat_customers"), base, 2).alias("repeat_purchase_rate_pct")
    )


def kpi_panel(star: Star, params: Params) -> DataFrame:
    """Nine KPIs in one row, from three passes: order ledger, product cost, customers."""
    per_customer = star.order_ledger().groupBy("customer_key").agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(c) for c in ("gross_c", "discount_c", "net_c", "units", "refund_c", "units_returned")],
    )
    totals = per_customer.agg(
        F.sum("n").alias("total_orders"),
        F.count_if(F.col("n") >= 2).alias("repeat_customers"),
        *[F.sum(c).alias(c) for c in ("gross_c", "discount_c", "net_c", "units", "refund_c", "units_returned")],
    )
    margin = _margin_totals(star).select(_margin().alias("m")).scalar()
    base = _scalar(_customer_totals(star), "total_customers")
    return totals.select(
        currency(F.col("net_c")).alias("order_net_revenue"),
        currency(F.col("net_c") - F.col("refund_c")).alias("net_revenue"),
        margin.alias("gross_margin_pct"),
        mean_currency(F.col("net_c"), F.col("total_orders")).alias("avg_order_value"),
        pct(F.col("discount_c"), F.col("gross_c"), 2).alias("discount_impact_pct"),
        pct(F.col("units_returned"), F.col("units"), 2).alias("return_rate_pct"),
        pct(F.col("repeat_customers"), base, 2).alias("repeat_purchase_rate_pct"),
        "total_orders",
        base.alias("total_customers"),
    )
