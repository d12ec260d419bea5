"""Regional and city performance against the full customer base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.bands import quadrant
from merchlens.functions.dates import span_of_years
from merchlens.functions.money import currency, mean_currency, pct, ratio
from merchlens.operators.shares import share, total, whole
from merchlens.params import Params
from merchlens.sources.star import Star


def _buyers(star: Star) -> DataFrame:
    """region, customer_key, orders, net_c."""
    return (
        star.orders_by_customer("geography_key")
        .join(star.geography().select("geography_key", "region"), "geography_key")
        .groupBy("region", "customer_key")
        .agg(F.sum("orders").alias("orders"), F.sum("net_c").alias("net_c"))
    )


def _region_sales(star: Star) -> DataFrame:
    return _buyers(star).groupBy("region").agg(
        F.count("*").alias("buyers"),
        F.count_if(F.col("orders") >= 2).alias("repeaters"),
        F.sum("orders").alias("orders"),
        F.sum("net_c").alias("net_c"),
    )


def _city_base(star: Star) -> DataFrame:
    return (
        star.customers("home_geography_key")
        .groupBy(F.col("home_geography_key").alias("geography_key"))
        .agg(F.count("*").alias("customers"))
    )


def _region_base(star: Star) -> DataFrame:
    return (
        _city_base(star)
        .join(star.geography().select("geography_key", "region"), "geography_key")
        .groupBy("region")
        .agg(F.sum("customers").alias("customers"))
    )


def _per_customer(base: DataFrame, sales: DataFrame, key: str) -> DataFrame:
    """Base and sales per place with the national revenue per customer.

    A full join keeps places with only one of the two in the national figure.
    """
    rows = base.join(sales, key, "full").withColumn(
        "national", ratio(total(F.col("net_c")), total(F.col("customers")))
    )
    return rows.filter("customers is not null and net_c is not null")


def _rpc() -> Column:
    return ratio(F.col("net_c"), F.col("customers"))


def _index() -> Column:
    return pct(_rpc(), F.col("national"))


def region_revenue(star: Star, params: Params) -> DataFrame:
    return _region_sales(star).select(
        "region",
        F.col("buyers").alias("purchasing_customers"),
        "orders",
        currency(F.col("net_c")).alias("order_net_revenue"),
        share(F.col("net_c")).alias("pct_of_revenue"),
    )


def region_rpc_index(star: Star, params: Params) -> DataFrame:
    return _per_customer(_region_base(star), _region_sales(star), "region").select(
        "region",
        "customers",
        currency(F.col("net_c")).alias("revenue"),
        mean_currency(F.col("net_c"), F.col("customers")).alias("revenue_per_customer"),
        mean_currency(F.col("national"), F.lit(1)).alias("national_rpc"),
        _index().alias("rpc_index"),
    )


def city_rpc_index(star: Star, params: Params) -> DataFrame:
    sales = (
        star.orders_by_customer("geography_key").groupBy("geography_key").agg(F.sum("net_c").alias("net_c"))
    )
    rows = _per_customer(_city_base(star), sales, "geography_key")
    return rows.join(star.geography(), "geography_key").select(
        "geography_key",
        "city",
        "region",
        "customers",
        mean_currency(F.col("net_c"), F.col("customers")).alias("revenue_per_customer"),
        _index().alias("rpc_index"),
        F.when(F.col("customers") < params.low_base_customers, "LOW_BASE_CAUTION")
        .otherwise("RELIABLE")
        .alias("sample_reliability"),
    )


def region_customer_quality(star: Star, params: Params) -> DataFrame:
    return _region_sales(star).join(_region_base(star), "region").select(
        "region",
        F.col("customers").alias("total_customers"),
        F.col("buyers").alias("purchasing_customers"),
        pct(F.col("repeaters"), F.col("customers")).alias("repeat_rate_pct"),
        mean_currency(F.col("net_c"), F.col("orders")).alias("aov"),
        mean_currency(F.col("net_c"), F.col("customers")).alias("revenue_per_customer"),
    )


def region_yoy(star: Star, params: Params) -> DataFrame:
    years = params.growth_years
    per = (
        star.orders_by_customer("geography_key", "year", during=span_of_years(years))
        .groupBy("geography_key", "year")
        .agg(F.sum("net_c").alias("net_c"))
        .join(star.geography().select("geography_key", "region"), "geography_key")
        .groupBy("region")
        .pivot("year", list(years))
        .agg(F.sum("net_c"))
    )
    one, two, three = (F.col(str(y)) for y in years)
    return per.select(
        "region",
        currency(one).alias("rev_year_1"),
        currency(two).alias("rev_year_2"),
        currency(three).alias("rev_year_3"),
        pct(two - one, one).alias("yoy_year_2_pct"),
        pct(three - two, two).alias("yoy_year_3_pct"),
    )


def region_acquisition_by_year(star: Star, params: Params) -> DataFrame:
    per_city = (
        star.customers("customer_key", "home_geography_key", "signup_date")
        .groupBy(F.col("home_geography_key").alias("geography_key"), F.year("signup_date").alias("year"))
        .agg(F.count("*").alias("customers"))
    )
    counts = [
        F.sum(F.when(F.col("year") == y, F.col("customers")).otherwise(0)).alias(f"acquired_year_{i}")
        for i, y in enumerate(params.growth_years, start=1)
    ]
    return (
        per_city.join(star.geography().select("geography_key", "region"), "geography_key")
        .groupBy("region")
        .agg(*counts)
    )


def region_quadrants(star: Star, params: Params) -> DataFrame:
    rows = _per_customer(_region_base(star), _region_sales(star), "region").withColumn(
        "median_c", whole(F.median("net_c"))
    )
    return rows.select(
        "region",
        currency(F.col("net_c")).alias("revenue"),
        mean_currency(F.col("net_c"), F.col("customers")).alias("revenue_per_customer"),
        _index().alias("rpc_index"),
        quadrant(
            F.col("net_c") >= F.col("median_c"), _rpc() >= F.col("national"), "Revenue", "Value"
        ).alias("portfolio_quadrant"),
    )
