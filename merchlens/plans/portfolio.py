"""One portfolio row per customer, and what three high-value methods agree on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.bands import VALUE_CLASSES
from merchlens.functions.money import currency, exact_round, pct
from merchlens.operators import customers as cust
from merchlens.operators.selection import grouped_quantiles
from merchlens.operators.shares import share
from merchlens.params import Params
from merchlens.sources.star import Star


def customer_portfolio(star: Star, params: Params) -> DataFrame:
    rank, n = F.col("portfolio_value_rank"), F.col("base_size")
    return cust.customer_portfolio(star, params).select(
        "customer_key",
        "lifetime_orders",
        currency(F.col("clv_c")).alias("historical_clv"),
        "historical_value_class",
        "rfm_segment",
        "rfm_code",
        "executive_framework",
        "category_breadth",
        "channel_breadth",
        exact_round(F.col("purchase_cadence_days"), 4).alias("purchase_cadence_days"),
        "portfolio_value_rank",
        pct(rank, n, 2).alias("portfolio_value_percentile"),
    )


def portfolio_composition(star: Star, params: Params) -> DataFrame:
    scored, profiled = F.col("rfm_segment").isNotNull(), F.col("category_breadth").isNotNull()
    return cust.customer_portfolio(star, params, ranked=False).agg(
        F.count("*").alias("total_customers"),
        F.count_if(scored).alias("rfm_scored"),
        F.count_if(profiled).alias("behavioral_population"),
        F.count_if(~scored).alias("excluded_non_purchasers"),
        F.count_if(scored & ~profiled).alias("excluded_zero_net_buyers"),
        currency(F.sum("clv_c")).alias("total_historical_clv"),
    )


def classification_drift(star: Star, params: Params) -> DataFrame:
    """Portfolio rows whose segment or class differs from a fresh derivation."""
    fresh_segment = cust.rfm_segments(star, money=False).select("customer_key", "segment")
    fresh_class = cust.behavioral_features(star, params).select(
        "customer_key", F.col("historical_value_class").alias("fresh_class")
    )
    rows = (
        cust.customer_portfolio(star, params, ranked=False)
        .select("customer_key", "rfm_segment", "historical_value_class")
        .join(fresh_segment, "customer_key", "left")
        .join(fresh_class, "customer_key", "left")
    )
    return rows.agg(
        F.count_if(~F.col("rfm_segment").eqNullSafe(F.col("segment"))).alias("rfm_segment_drift"),
        F.count_if(~F.col("historical_value_class").eqNullSafe(F.col("fresh_class"))).alias("value_class_drift"),
    )


def _champion() -> Column:
    return F.coalesce(F.col("rfm_segment") == "Champions", F.lit(False))


def _elite() -> Column:
    return F.coalesce(F.col("historical_value_class") == VALUE_CLASSES[3], F.lit(False))


def method_convergence(star: Star, params: Params) -> DataFrame:
    """Sizes and overlaps of three high-value sets, counted in one pass.

    Positive values rank first, so the top tenth of them are the ranks up to a
    tenth of their number.
    """
    rows = cust.held_portfolio(star, params, ranked=True)
    positive = rows.agg(F.count_if(F.col("clv_c") > 0).alias("n")).scalar()
    top = (F.col("clv_c") > 0) & (F.col("portfolio_value_rank") * 10 <= positive)
    flagged = rows.select(_champion().alias("a"), _elite().alias("b"), top.alias("c"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    sets = {
        "A RFM Champions": a,
        "B Elite value class": b,
        "C Top value decile": c,
        "A and B": a & b,
        "A and C": a & c,
        "B and C": b & c,
        "A and B and C": a & b & c,
    }
    counts = flagged.agg(*[F.count_if(cond).alias(name) for name, cond in sets.items()])
    return counts.unpivot([], counts.columns, "method_or_overlap", "customers")


def method_disagreement(star: Star, params: Params) -> DataFrame:
    champion, elite = _champion(), _elite()
    population = F.when(elite & ~champion, "Elite but NOT Champion").when(
        champion & ~elite, "Champion but NOT Elite"
    )
    rows = cust.held_portfolio(star, params).withColumn("disagreement_population", population)
    rows = rows.filter("disagreement_population is not null")
    q = grouped_quantiles(
        rows,
        ["disagreement_population"],
        {"clv": F.col("clv_c") / 100, "cadence": F.col("purchase_cadence_days")},
        {"clv50": ("clv", 0.5), "c50": ("cadence", 0.5)},
    )
    # Both populations are reported, also when empty.
    both = star.spark.createDataFrame(
        [("Elite but NOT Champion",), ("Champion but NOT Elite",)], "disagreement_population string"
    )
    sizes = rows.groupBy("disagreement_population").agg(F.count("*").alias("customers"))
    return (
        both.join(sizes, "disagreement_population", "left")
        .join(q, "disagreement_population", "left")
        .select(
            "disagreement_population",
            F.coalesce("customers", F.lit(0)).cast("bigint").alias("customers"),
            exact_round(F.col("clv50"), 2).alias("median_historical_clv"),
            exact_round(F.col("c50"), 0).alias("median_cadence_days"),
        )
    )


def portfolio_by_framework(star: Star, params: Params) -> DataFrame:
    rows = cust.held_portfolio(star, params)
    q = grouped_quantiles(
        rows,
        ["executive_framework"],
        {"cadence": F.col("purchase_cadence_days")},
        {"c50": ("cadence", 0.5)},
    )
    few = rows.groupBy("executive_framework").agg(
        F.count("*").alias("customers"),
        F.sum("clv_c").alias("clv_c"),
        F.percentile("category_breadth", 0.5).alias("median_category_breadth"),
    )
    return few.join(q, "executive_framework", "left").select(
        "executive_framework",
        "customers",
        share(F.col("customers")).alias("pct_of_portfolio"),
        currency(F.col("clv_c")).alias("total_historical_clv"),
        share(F.col("clv_c")).alias("pct_of_portfolio_value"),
        "median_category_breadth",
        exact_round(F.col("c50"), 0).alias("median_cadence_days"),
    )
