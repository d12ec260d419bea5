"""Customer-grain tables that several reports start from."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.bands import cadence_band, frequency_score, value_class
from merchlens.operators.ranking import with_rank, with_tile, with_tile_of_few
from merchlens.session import stage

if TYPE_CHECKING:
    from merchlens.params import Params
    from merchlens.sources.star import Star

_SUMS = ("gross_c", "discount_c", "net_c", "units", "refund_c", "units_returned")

# Recency and frequency scores to segment, first match wins.
SEGMENT_RULES = [
    # segment, recency scores, frequency scores
    ("Champions", (4, 5), (4, 5)),
    ("Loyal", (3, 4, 5), (3, 4, 5)),
    ("Potential Loyalists", (4, 5), (2,)),
    ("New / Recent", (4, 5), (1,)),
    ("Promising", (3,), (1, 2)),
    ("Needs Attention", (2,), (3, 4, 5)),
    ("At Risk", (2,), (1, 2)),
    ("Cant Lose", (1,), (4, 5)),
    ("Hibernating", (1,), (2, 3)),
    ("Lost", (1,), (1,)),
]
# Segments by the action they call for.
FRAMEWORK = {
    "1 Protect": ("Champions", "Loyal"),
    "2 Grow": ("Potential Loyalists", "Promising"),
    "3 Convert": ("At Risk", "Lost"),
}
FRAMEWORK_OTHER = "4 Other"
FRAMEWORK_NONE = "5 Not activated"


def buyer_totals(star: Star, breadth: bool = False) -> DataFrame:
    """One row per customer with an order: sums of the order ledger.

    ``breadth`` asks for ``channel_breadth`` too.
    """
    held = star.held.get("buyer_totals")
    if held is not None and (not breadth or "channel_breadth" in held.columns):
        return held
    return _buyer_totals(star)


def hold_buyer_totals(star: Star, breadth: bool = False) -> None:
    """Store the buyer totals for a job that starts from them more than once,
    so that the facts are read and shuffled once."""
    if "buyer_totals" not in star.held:
        rows = _buyer_totals(star)
        star.held["buyer_totals"] = stage(rows if breadth else rows.drop("channel_breadth"), "buyer-totals")


def _buyer_totals(star: Star) -> DataFrame:
    return star.order_ledger().groupBy("customer_key").agg(
        F.count("*").alias("orders"),
        *[F.sum(c).alias(c) for c in _SUMS],
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        F.count_distinct("sales_channel_key").alias("channel_breadth"),
    )


def customer_ledger(star: Star, *attributes: str) -> DataFrame:
    """Every customer with lifetime sums; ``value_c`` is net sales less refunds.

    Customers without an order keep zeros.
    """
    return (
        star.customers("customer_key", *attributes)
        .join(buyer_totals(star), "customer_key", "left")
        .fillna(0, ["orders", *_SUMS])
        .withColumn("value_c", F.col("net_c") - F.col("refund_c"))
    )


def historical_clv(star: Star) -> DataFrame:
    return customer_ledger(star).select(
        "customer_key", F.col("orders").alias("lifetime_orders"), F.col("value_c").alias("clv_c")
    )


def buyers_by_value(star: Star, *attributes: str) -> DataFrame:
    """Buyers with their value decile, 1 the highest; ties go by customer key."""
    who = ("customer_key", *attributes)
    rows = customer_ledger(star, *attributes).filter("orders > 0").select(*who, "orders", "net_c", "value_c")
    return with_tile(rows, 10, F.desc("value_c"), F.col("customer_key"), tile="decile")


def buyer_values(star: Star) -> DataFrame:
    """customer_key, value_c of everyone with an order."""
    return customer_ledger(star).filter("orders > 0").select("customer_key", "value_c")


def segment_of(r: Column, f: Column) -> Column:
    out = F
    for name, rs, fs in SEGMENT_RULES:
        out = out.when(r.isin(*rs) & f.isin(*fs), name)
    return out


def rfm_scores(star: Star, money: bool = True) -> DataFrame:
    """Recency, frequency and monetary scores of every buyer at the horizon.

    The monetary score takes an order of all buyers and is left out without ``money``.
    """
    # Stored, as the recency score reads the buyers more than once.
    base = stage(
        star.final_buyers().select(
            "customer_key",
            "recency_days",
            F.col("cumulative_orders_to_date").alias("frequency"),
            F.col("cumulative_net_c").alias("monetary_c"),
        ),
        "buyers",
    )
    scored = with_tile_of_few(base, 5, "recency_days", F.col("customer_key"), tile="_r")
    if money:
        scored = with_tile(scored, 5, F.col("monetary_c"), F.col("customer_key"), tile="m_score")
    return scored.select(
        "customer_key",
        "recency_days",
        "frequency",
        "monetary_c",
        (6 - F.col("_r")).alias("r_score"),
        frequency_score(F.col("frequency")).cast("bigint").alias("f_score"),
        *(["m_score"] if money else []),
    )


def rfm_segments(star: Star, money: bool = True) -> DataFrame:
    """Scores with the segment, which hangs on recency and frequency only; the code needs ``money``."""
    code = F.concat(F.lit("R"), "r_score", F.lit("F"), "f_score", F.lit("M"), "m_score").alias("rfm_code")
    return rfm_scores(star, money).select(
        "*", *([code] if money else []), segment_of(F.col("r_score"), F.col("f_score")).alias("segment")
    )


def behavioral_features(star: Star, params: Params) -> DataFrame:
    """Breadth and cadence of every customer with positive value.

    The mean gap between consecutive orders is the span from first to last order
    over the number of gaps, so no per-customer sort is needed. Value, channels
    and span come from one pass over the orders.
    """
    categories = (
        star.lines("customer_key", "product_key")
        .join(star.products("product_key", "category"), "product_key")
        .groupBy("customer_key")
        .agg(F.count_distinct("category").alias("category_breadth"))
    )
    span = F.datediff("last_order", "first_order").cast("double")
    return (
        buyer_totals(star, breadth=True)
        .withColumn("clv_c", F.col("net_c") - F.col("refund_c"))
        .filter("clv_c > 0")
        .join(categories, "customer_key", "left")
        .select(
            "customer_key",
            F.col("orders").alias("order_frequency"),
            "clv_c",
            value_class(F.col("clv_c"), params.value_cuts_c).alias("historical_value_class"),
            "category_breadth",
            "channel_breadth",
            F.when(F.col("orders") > 1, span / (F.col("orders") - 1)).alias("purchase_cadence_days"),
        )
    )


def cadence_of(params: Params) -> Column:
    return cadence_band(F.col("purchase_cadence_days"), params.cadence_cuts)


def framework_of(segment: Column) -> Column:
    out = F.when(segment.isNull(), FRAMEWORK_NONE)
    for group, members in FRAMEWORK.items():
        out = out.when(segment.isin(*members), group)
    return out.otherwise(FRAMEWORK_OTHER)


def customer_portfolio(star: Star, params: Params, ranked: bool = True) -> DataFrame:
    """Every customer with value, class, segment and features; ``ranked`` adds the
    value rank and the code, each an order of all customers."""
    hold_buyer_totals(star, breadth=True)
    segments = rfm_segments(star, money=ranked).select(
        "customer_key", F.col("segment").alias("rfm_segment"), *(["rfm_code"] if ranked else [])
    )
    features = behavioral_features(star, params).select(
        "customer_key",
        "historical_value_class",
        "category_breadth",
        "channel_breadth",
        "purchase_cadence_days",
    )
    rows = (
        historical_clv(star)
        .join(segments, "customer_key", "left")
        .join(features, "customer_key", "left")
        .withColumn("executive_framework", framework_of(F.col("rfm_segment")))
    )
    if not ranked:
        return rows
    return with_rank(
        rows, F.desc("clv_c"), F.col("customer_key"), rank="portfolio_value_rank", total="base_size"
    )


def held_portfolio(star: Star, params: Params, ranked: bool = False) -> DataFrame:
    """The portfolio, stored for a job that reads it more than once."""
    held = star.held.get("portfolio")
    if held is None or (ranked and "portfolio_value_rank" not in held.columns):
        rows = customer_portfolio(star, params, ranked)
        # Ranking stores its rows already.
        star.held["portfolio"] = held = rows if ranked else stage(rows, "portfolio")
    return held
