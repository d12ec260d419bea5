"""RFM segmentation at the final snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions.money import currency, exact_round, mean_currency, ratio
from merchlens.operators import customers as cust
from merchlens.operators.shares import share
from merchlens.params import Params
from merchlens.sources.star import Star


def frequency_distribution(star: Star, params: Params) -> DataFrame:
    """Order counts are few distinct values, so the built-in percentile's value
    counts stay small."""
    n = F.col("cumulative_orders_to_date")
    return (
        star.final_buyers()
        .agg(
            F.percentile(n, [0.5, 0.75, 0.9, 0.95]).alias("p"),
            F.max(n).alias("freq_max"),
            exact_round(ratio(F.sum(n), F.count("*")), 2).alias("freq_mean"),
        )
        .select(
            *[
                exact_round(F.col("p")[i], 0).alias(name)
                for i, name in enumerate(("freq_median", "freq_p75", "freq_p90", "freq_p95"))
            ],
            "freq_max",
            "freq_mean",
        )
    )


def rfm_scores(star: Star, params: Params) -> DataFrame:
    return cust.rfm_scores(star).withColumn("monetary", currency(F.col("monetary_c"))).drop("monetary_c")


def rfm_score_distribution(star: Star, params: Params) -> DataFrame:
    return cust.rfm_scores(star).groupBy("r_score", "f_score", "m_score").agg(F.count("*").alias("customers"))


def rfm_segments(star: Star, params: Params) -> DataFrame:
    return cust.rfm_segments(star).withColumn("monetary", currency(F.col("monetary_c"))).drop("monetary_c")


def rfm_segment_summary(star: Star, params: Params) -> DataFrame:
    return (
        cust.rfm_segments(star, money=False)
        .groupBy("segment")
        .agg(
            F.count("*").alias("customers"),
            F.sum("monetary_c").alias("value_c"),
            F.sum("frequency").alias("orders"),
            F.sum("recency_days").alias("recency"),
        )
        .select(
            "segment",
            "customers",
            share(F.col("customers")).alias("pct_of_customers"),
            currency(F.col("value_c")).alias("net_revenue"),
            share(F.col("value_c")).alias("pct_of_net_revenue"),
            mean_currency(F.col("value_c"), F.col("customers")).alias("avg_clv"),
            exact_round(ratio(F.col("orders"), F.col("customers")), 2).alias("avg_orders"),
            exact_round(ratio(F.col("recency"), F.col("customers")), 0).alias("avg_recency_days"),
        )
    )


def rfm_reconciliation(star: Star, params: Params) -> DataFrame:
    """Scored and unscored customers make up the base; scored value is all net revenue."""
    base = star.customers("customer_key").agg(F.count("*").alias("n")).scalar()
    sales = star.orders("net_c").agg(F.sum("net_c").alias("net_c")).scalar()
    refunds = star.returns("refund_c").agg(F.sum("refund_c").alias("refund_c")).scalar()
    scored = cust.rfm_segments(star, money=False).agg(
        F.sum("monetary_c").alias("value_c"),
        F.count("*").alias("scored"),
        F.count_if(F.col("segment").isNull()).alias("unclassified"),
    )
    rows = scored.select("*", base.alias("base"), (sales - F.coalesce(refunds, F.lit(0))).alias("net_c"))
    ok = (F.col("value_c") == F.col("net_c")) & (F.col("unclassified") == 0)
    return rows.select(
        currency(F.col("value_c")).alias("rfm_net_revenue"),
        F.col("scored").alias("scored_customers"),
        (F.col("base") - F.col("scored")).alias("non_purchasers"),
        F.when(ok, "PASS").otherwise("FAIL").alias("regression_result"),
    )
