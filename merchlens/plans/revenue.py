"""Revenue by period, channel and category, growth, variance and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.dates import span_of_years
from merchlens.functions.money import currency, mean_currency, pct
from merchlens.operators.shares import share, total, whole
from merchlens.params import Params
from merchlens.sources.star import Star

_PARTS = {"year": F.year, "quarter": F.quarter, "month": F.month}


def _by_period(star: Star, *parts: str) -> DataFrame:
    return (
        star.orders("order_date", "net_c")
        .groupBy(*[_PARTS[p]("order_date").alias(p) for p in parts])
        .agg(F.count("*").alias("orders"), F.sum("net_c").alias("net_c"))
    )


def revenue_by_year(star: Star, params: Params) -> DataFrame:
    return _by_period(star, "year").select(
        "year",
        "orders",
        currency(F.col("net_c")).alias("order_net_revenue"),
        share(F.col("net_c"), 2).alias("pct_of_total"),
    )


def revenue_by_quarter(star: Star, params: Params) -> DataFrame:
    return _by_period(star, "year", "quarter").select(
        "year", "quarter", "orders", currency(F.col("net_c")).alias("order_net_revenue")
    )


def revenue_by_month(star: Star, params: Params) -> DataFrame:
    return _by_period(star, "year", "month").select(
        "year", "month", "orders", currency(F.col("net_c")).alias("order_net_revenue")
    )


def _growth(star: Star, *within: str) -> tuple[DataFrame, Column]:
    """Revenue per year (and part of year) with the previous present year's."""
    prior = F.lag("net_c").over(Window.partitionBy(*within).orderBy("year"))
    rows = _by_period(star, "year", *within).withColumn("prior_c", prior)
    return rows, pct(F.col("net_c") - F.col("prior_c"), F.col("prior_c"))


def revenue_yoy_annual(star: Star, params: Params) -> DataFrame:
    rows, growth = _growth(star)
    return rows.select(
        "year",
        currency(F.col("net_c")).alias("order_net_revenue"),
        currency(F.col("prior_c")).alias("prior_year"),
        growth.alias("yoy_growth_pct"),
    )


def revenue_yoy_quarter(star: Star, params: Params) -> DataFrame:
    rows, growth = _growth(star, "quarter")
    return rows.select(
        "year",
        "quarter",
        currency(F.col("net_c")).alias("order_net_revenue"),
        growth.alias("yoy_same_quarter_pct"),
    )


def revenue_yoy_month(star: Star, params: Params) -> DataFrame:
    rows, growth = _growth(star, "month")
    return rows.select(
        "year",
        "month",
        currency(F.col("net_c")).alias("order_net_revenue"),
        growth.alias("yoy_same_month_pct"),
    )


def revenue_by_sales_channel(star: Star, params: Params) -> DataFrame:
    return star.orders_by_sales_channel().select(
        "channel_name",
        "orders",
        currency(F.col("net_c")).alias("order_net_revenue"),
        mean_currency(F.col("net_c"), F.col("orders")).alias("aov"),
        share(F.col("net_c")).alias("pct_of_revenue"),
    )


def _by_category(star: Star) -> DataFrame:
    sold = (
        star.lines("product_key", "quantity", "net_c")
        .groupBy("product_key")
        .agg(F.sum("net_c").alias("net_c"), F.sum("quantity").alias("units"))
    )
    return (
        sold.join(star.products("product_key", "category"), "product_key")
        .groupBy("category")
        .agg(F.sum("net_c").alias("net_c"), F.sum("units").alias("units"))
    )


def revenue_by_category(star: Star, params: Params) -> DataFrame:
    return _by_category(star).select(
        "category",
        currency(F.col("net_c")).alias("order_net_revenue"),
        share(F.col("net_c")).alias("pct_of_revenue"),
        F.col("units").alias("units_sold"),
    )


def _by_category_year(star: Star, *years: int) -> DataFrame:
    during = span_of_years(years) if years else None
    lines = star.lines("product_key", "order_date", "net_c", during=during).withColumn("year", F.year("order_date"))
    if years:
        lines = lines.filter(F.col("year").isin(*years))
    sold = lines.groupBy("product_key", "year").agg(F.sum("net_c").alias("net_c"))
    return (
        sold.join(star.products("product_key", "category"), "product_key")
        .groupBy("category", "year")
        .agg(F.sum("net_c").alias("net_c"))
    )


def revenue_category_year(star: Star, params: Params) -> DataFrame:
    return _by_category_year(star).select(
        "category", "year", currency(F.col("net_c")).alias("order_net_revenue")
    )


def revenue_category_concentration(star: Star, params: Params) -> DataFrame:
    # One row per category: a global order is cheap here.
    best_first = Window.orderBy(F.desc("net_c"), "category")
    return _by_category(star).select(
        "category",
        currency(F.col("net_c")).alias("order_net_revenue"),
        share(F.col("net_c")).alias("pct_of_revenue"),
        pct(F.sum("net_c").over(Window.orderBy(F.desc("net_c"))), total(F.col("net_c"))).alias("cumulative_pct"),
        F.row_number().over(best_first).cast("bigint").alias("revenue_rank"),
    )


def _variance(rows: DataFrame, name: str, params: Params) -> DataFrame:
    """``rows``: name, year, net_c of the two compared years."""
    base, later = params.variance_years

    def of(year: int) -> Column:
        return F.sum(F.when(F.col("year") == year, F.col("net_c")).otherwise(0))

    change = F.col("later_c") - F.col("base_c")
    return (
        rows.groupBy(name)
        .agg(of(base).alias("base_c"), of(later).alias("later_c"))
        .select(
            name,
            currency(F.col("base_c")).alias("rev_base_year"),
            currency(F.col("later_c")).alias("rev_next_year"),
            currency(change).alias("yoy_change"),
            share(change).alias("pct_of_total_change"),
        )
    )


def variance_by_channel(star: Star, params: Params) -> DataFrame:
    years = params.variance_years
    per = star.orders_by_sales_channel("year", during=span_of_years(years)).filter(F.col("year").isin(*years))
    return _variance(per, "channel_name", params)


def variance_by_category(star: Star, params: Params) -> DataFrame:
    return _variance(_by_category_year(star, *params.variance_years), "category", params)


def revenue_path_reconciliation(star: Star, params: Params) -> DataFrame:
    """The revenue total by four aggregation paths; each must equal the header total."""
    paths = {
        "header_total": star.orders("net_c").agg(F.sum("net_c").alias("net_c")),
        "header_by_year": _by_period(star, "year"),
        "header_by_channel": star.orders("sales_channel_key", "net_c")
        .groupBy("sales_channel_key")
        .agg(F.sum("net_c").alias("net_c")),
        "line_by_category": _by_category(star),
    }
    rows = reduce(
        DataFrame.unionByName,
        [df.agg(F.sum("net_c").alias("net_c")).select(F.lit(p).alias("path"), "net_c") for p, df in paths.items()],
    )
    header = whole(F.max(F.when(F.col("path") == "header_total", F.col("net_c"))))
    return rows.select(
        "path",
        currency(F.col("net_c")).alias("order_net_revenue"),
        F.when(F.col("net_c") == header, "PASS").otherwise("FAIL").alias("regression_result"),
    )
