"""Bring a stored snapshot up to date by the months that changed, and no others."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions.dates import month_index
from merchlens.sources.publish import publish_months
from merchlens.sources.star import Star, StoredStar, stored_snapshot

SNAPSHOT = "fact_customer_monthly_snapshot"


def _first_of(month: int) -> dt.date:
    return dt.date(month // 12, month % 12 + 1, 1)


def _months(star: Star) -> DataFrame:
    """Per month what orders and returns say of customers, as sums that any changed row changes."""
    orders = star.orders("customer_key", "order_date", "net_c").select(
        month_index(F.col("order_date")).alias("m"), F.xxhash64(F.lit("order"), "customer_key", "order_date", "net_c").alias("h")
    )
    back = star.returns("customer_key", "return_date", "refund_c").select(
        month_index(F.col("return_date")).alias("m"), F.xxhash64(F.lit("return"), "customer_key", "return_date", "refund_c").alias("h")
    )
    # Two halves of the hash, so that no sum outgrows a BIGINT.
    return orders.unionByName(back).groupBy("m").agg(
        F.count("*").alias("n"), F.sum(F.shiftright("h", 32)).alias("high"), F.sum(F.col("h").bitwiseAND(F.lit((1 << 32) - 1))).alias("low")
    )


def first_changed_month(before: Star, after: Star) -> dt.date | None:
    """The first day of the earliest month whose orders or returns differ between two stars; None if none do."""
    side = _months(before).toDF("m0", "n0", "high0", "low0")
    both = _months(after).join(side, F.col("m") == F.col("m0"), "full")
    same = (F.col("n") == F.col("n0")) & (F.col("high") == F.col("high0")) & (F.col("low") == F.col("low0"))
    found = both.filter(~F.coalesce(same, F.lit(False))).agg(F.min(F.coalesce("m", "m0"))).first()[0]
    return None if found is None else _first_of(found)


def append_months(star: Star, root: str, since: dt.date) -> int:
    """Publish the months of the snapshot below ``root`` from that of ``since`` to the star's horizon; the rows then stored.

    The month before is read from the stored snapshot and stands for all events up to it, so ``since`` must not lie
    after the first month in which an order or return was added, changed or taken away (``first_changed_month``).
    Months before it are neither read nor written. A customer who signed up earlier, but has no row in the stored
    month before, cannot be carried on from it, so that raises.
    """
    since = since.replace(day=1)
    last = since - dt.timedelta(days=1)
    stored = StoredStar(star.spark, root)
    state = stored.snapshot_of(last)
    known = state.select(F.col("customer_key").alias("known"))
    lost = star.customers("customer_key", "signup_date").filter(F.col("signup_date") <= F.lit(last))
    lost = lost.join(known, F.col("customer_key") == F.col("known"), "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"customer {lost[0].customer_key} signed up before {since} and is not in the stored month")
    rows = star.snapshot_since(since, state)
    return publish_months(stored_snapshot(rows), root, SNAPSHOT, since.year * 100 + since.month)
