"""How concentrated customer value is: ladder, decile share, Lorenz, Gini."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.money import currency, exact_round, pct
from merchlens.operators.customers import buyers_by_value, historical_clv
from merchlens.operators.running import rows_between, running_by_value
from merchlens.params import Params
from merchlens.sources.star import Star

FULL, BUYERS = "Primary - complete portfolio", "Reconciliation - purchaser base"
# The ladder's steps in percent of customers.
LADDER = (1, 5, 10, 20, 50)
LORENZ_POINTS = 10


def _both_bases(star: Star) -> DataFrame:
    """Each customer once per base it belongs to: everyone, and buyers."""
    bases = F.array(F.lit(FULL), F.when(F.col("lifetime_orders") > 0, BUYERS))
    return historical_clv(star).select(
        F.explode(F.array_compact(bases)).alias("analytical_basis"), "customer_key", "clv_c"
    )


def concentration_bases(star: Star, params: Params) -> DataFrame:
    return (
        _both_bases(star)
        .groupBy("analytical_basis")
        .agg(F.count("*").alias("customers"), currency(F.sum("clv_c")).alias("total_historical_clv"))
    )


def topn_ladder(star: Star, params: Params) -> DataFrame:
    values = running_by_value(_both_bases(star), ["analytical_basis"], "clv_c", descending=True)

    def held(p: int) -> Column:
        top = F.floor(F.col("total_n") * p / 100)
        return F.sum(rows_between(F.lit(0), top) * F.col("clv_c"))

    return values.groupBy("analytical_basis").agg(
        *[pct(held(p), F.max("total_sum")).alias(f"top_{p}_pct") for p in LADDER]
    )


def top_decile_share(star: Star, params: Params) -> DataFrame:
    top = F.when(F.col("decile") == 1, F.col("value_c"))
    return buyers_by_value(star).agg(
        F.count("*").alias("purchaser_base"), pct(F.sum(top), F.sum("value_c")).alias("top_decile_share_pct")
    )


def lorenz_curve(star: Star, params: Params) -> DataFrame:
    """Share of value the poorest customers hold, at ten points of the base.

    Points fall on ranks that are whole multiples of a tenth of the base, so a
    base not divisible by ten has fewer of them. A point inside a run of equal
    values takes as many of them as its rank asks for.
    """
    values = running_by_value(historical_clv(star), [], "clv_c")
    below = [
        F.struct(F.lit(at).alias("at"), F.sum(rows_between(F.lit(0), F.floor(F.col("total_n") * at / LORENZ_POINTS)) * F.col("clv_c")).alias("below_c"))
        for at in range(1, LORENZ_POINTS + 1)
    ]
    points = values.agg(F.max("total_n").alias("n"), F.max("total_sum").alias("total_c"), F.array(*below).alias("points"))
    rank = F.col("n") * F.col("at") / LORENZ_POINTS
    return points.select("n", "total_c", F.inline("points")).filter((F.col("n") * F.col("at")) % LORENZ_POINTS == 0).select(
        pct(rank, F.col("n")).alias("cumulative_customer_pct"),
        pct(F.col("below_c"), F.col("total_c"), 2).alias("cumulative_value_pct"),
    )


def gini(star: Star, params: Params) -> DataFrame:
    values = running_by_value(_both_bases(star), ["analytical_basis"], "clv_c")
    # Ranks of equal values add up as a run of whole numbers; rank x value outgrows BIGINT on large bases.
    n, before = (F.col(c).cast("decimal(18,0)") for c in ("n", "before_n"))
    ranks = n * before + n * (n + 1) / 2
    weighted = F.sum(ranks * F.col("clv_c").cast("decimal(18,0)")).cast("double")
    base, value = F.max("total_n").cast("double"), F.max("total_sum").cast("double")
    return values.groupBy("analytical_basis").agg(
        exact_round(2.0 * weighted / F.nullif(base * value, F.lit(0.0)) - (base + 1.0) / base, 4).alias("gini_coefficient")
    )
