"""Signup cohorts: size, retention, revenue and value by maturity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.bands import MATURITY_LAST, maturity
from merchlens.functions.dates import month_index, month_start
from merchlens.functions.money import currency, exact_round, mean_currency, pct
from merchlens.operators import customers as cust
from merchlens.params import Params
from merchlens.plans.marketing import customer_orders
from merchlens.sources.star import Star

# The segments reported per maturity class.
MIX_SEGMENTS = ("Champions", "Loyal", "At Risk", "Lost")
# Fixed value: the months a retention curve runs over.
CURVE_MONTHS = 12


def _aged(customers: DataFrame, star: Star) -> DataFrame:
    end = star.horizon.year * 12 + star.horizon.month - 1
    months = F.lit(end).cast("bigint") - month_index(F.col("signup_date"))
    return customers.select(
        "*",
        month_start(F.col("signup_date")).alias("cohort_month"),
        months.alias("observable_months"),
        maturity(months).alias("maturity_class"),
    )


def _cohorts(star: Star) -> DataFrame:
    return (
        _aged(star.customers("signup_date"), star)
        .groupBy("cohort_month", "observable_months", "maturity_class")
        .agg(F.count("*").alias("cohort_customers"))
    )


def cohort_base(star: Star, params: Params) -> DataFrame:
    return _cohorts(star).select("cohort_month", "cohort_customers", "observable_months", "maturity_class")


def cohort_maturity_summary(star: Star, params: Params) -> DataFrame:
    return _cohorts(star).groupBy("maturity_class").agg(
        F.count("*").alias("cohorts"),
        F.sum("cohort_customers").alias("customers"),
        F.min("observable_months").alias("min_observable_months"),
        F.max("observable_months").alias("max_observable_months"),
    )


def _retention(star: Star) -> DataFrame:
    """Orders shrink to customer months before they meet the customers, so each
    customer counts once per age without a distinct count."""
    active = (
        star.orders("customer_key", "order_date")
        .groupBy("customer_key", month_index(F.col("order_date")).alias("m"))
        .agg(F.count("*").alias("_n"))
    )
    per_age = (
        active.join(star.customers("customer_key", "signup_date"), "customer_key")
        .withColumn("age_months", F.col("m") - month_index(F.col("signup_date")))
        .filter("age_months >= 0")
        .groupBy(month_start(F.col("signup_date")).alias("cohort_month"), "age_months")
        .agg(F.count("*").alias("active_customers"))
    )
    return per_age.join(_cohorts(star), "cohort_month").select(
        "cohort_month",
        "maturity_class",
        "cohort_customers",
        "observable_months",
        F.col("age_months").cast("bigint").alias("age_months"),
        "active_customers",
        pct(F.col("active_customers"), F.col("cohort_customers")).alias("retention_pct"),
    )


def cohort_retention(star: Star, params: Params) -> DataFrame:
    return _retention(star)


def cohort_retention_curve(star: Star, params: Params) -> DataFrame:
    """Mean of the cohorts' rounded retention, mature cohorts only."""
    return (
        _retention(star)
        .filter((F.col("maturity_class") == MATURITY_LAST) & (F.col("age_months") <= CURVE_MONTHS))
        .groupBy("age_months")
        .agg(
            exact_round(F.avg("retention_pct"), 1).alias("avg_retention_pct"),
            F.sum("active_customers").alias("total_active"),
        )
    )


def engagement_curve(star: Star, params: Params) -> DataFrame:
    """Active share of buyers by months since the first purchase."""
    return (
        star.snapshot()
        .filter(F.col("months_since_first_purchase").between(0, CURVE_MONTHS))
        .groupBy(F.col("months_since_first_purchase").cast("bigint").alias("age_months"))
        .agg(F.count("*").alias("buyers_at_age"), F.count_if("is_active_flag").alias("engaged_customers"))
        .select("*", pct(F.col("engaged_customers"), F.col("buyers_at_age")).alias("engagement_pct"))
    )


def cohort_revenue(star: Star, params: Params) -> DataFrame:
    per_cohort = (
        _aged(customer_orders(star, "signup_date"), star)
        .groupBy("maturity_class", "cohort_month")
        .agg(F.sum("net_c").alias("net_c"), F.sum("orders").alias("orders"))
    )
    return (
        per_cohort.groupBy("maturity_class")
        .agg(F.count("*").alias("cohorts"), F.sum("net_c").alias("net_c"), F.sum("orders").alias("orders"))
        .select(
            "maturity_class",
            "cohorts",
            # A class without any order has no revenue to report, not zero.
            currency(F.when(F.col("orders") > 0, F.col("net_c"))).alias("order_net_revenue"),
            "orders",
            mean_currency(F.col("net_c"), F.col("orders")).alias("aov"),
        )
    )


def cohort_customer_value(star: Star, params: Params) -> DataFrame:
    return (
        _aged(cust.customer_ledger(star, "signup_date"), star)
        .groupBy("maturity_class")
        .agg(F.count("*").alias("customers"), F.sum("value_c").alias("value_c"))
        .select(
            "maturity_class",
            "customers",
            currency(F.col("value_c")).alias("net_revenue"),
            mean_currency(F.col("value_c"), F.col("customers")).alias("value_per_acquired_customer"),
        )
    )


def cohort_rfm_mix(star: Star, params: Params) -> DataFrame:
    """Mix of four segments per class; the percentage is of those four only."""
    rows = (
        cust.rfm_segments(star, money=False)
        .filter(F.col("segment").isin(*MIX_SEGMENTS))
        .select("customer_key", "segment")
        .join(star.customers("customer_key", "signup_date"), "customer_key")
    )
    in_class = F.sum("customers").over(Window.partitionBy("maturity_class"))
    return (
        _aged(rows, star)
        .groupBy("maturity_class", "segment")
        .agg(F.count("*").alias("customers"))
        .select("*", pct(F.col("customers"), in_class).alias("pct_of_cohort_class"))
    )
