"""The customer-by-month snapshot.

Every customer has a row for each month end from signup to the horizon, most of
them with nothing new. So the shuffles carry only months in which something
changes: an order or refund month, the month an event leaves the trailing year,
a month end within 90 days of an order, the signup month. Running windows give
the measures at those months, and the rows between two of them are filled in
last, without another shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.dates import month_end_of_index, month_index

# Thresholds of the snapshot flags and windows.
ACTIVE_DAYS = 90
RISK_DAYS = 60
WINDOW_DAYS = (30, 90)
TRAILING_MONTHS = 12
# A window of 90 days reaches from an order over at most this many later month ends.
_MONTH_ENDS = 3


def _change(month: Column, **given: Column) -> Column:
    """One row of the change table; what is not given is zero or NULL."""
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("date")
    blank = {
        "orders": zero, "gain_c": zero, "loss_c": zero, "last_order": none, "first_m": F.lit(None).cast("int"),
        "short": zero, "long": zero, "signup_date": none,
    }
    return F.struct(month.cast("int").alias("m"), *[c.alias(k) for k, c in {**blank, **given}.items()])


def _order_changes(orders: DataFrame) -> DataFrame:
    day, m = F.col("order_date"), month_index(F.col("order_date"))

    def within(k: int, days: int) -> Column:
        return (F.datediff(F.last_day(F.add_months(F.trunc(day, "MM"), k)), day) < days).cast("bigint")

    rows = [
        _change(
            m,
            orders=F.lit(1).cast("bigint"),
            gain_c=F.col("net_c"),
            last_order=day,
            first_m=m,
            short=within(0, WINDOW_DAYS[0]),
            long=within(0, WINDOW_DAYS[1]),
        )
    ]
    rows += [
        _change(m + k, short=within(k, WINDOW_DAYS[0]), long=within(k, WINDOW_DAYS[1]))
        for k in range(1, _MONTH_ENDS + 1)
    ]
    rows.append(_change(m + TRAILING_MONTHS, loss_c=F.col("net_c")))
    return orders.select("customer_key", F.inline(F.array(*rows))).filter(
        "orders > 0 or long > 0 or loss_c <> 0"
    )


def _return_changes(returns: DataFrame) -> DataFrame:
    m, back = month_index(F.col("return_date")), -F.col("refund_c")
    rows = F.array(_change(m, gain_c=back), _change(m + TRAILING_MONTHS, loss_c=back))
    return returns.select("customer_key", F.inline(rows))


def _state_changes(state: DataFrame, before: int) -> DataFrame:
    """What a stored month says of all that came before it, as one change in that month.

    What has left the trailing year by then is the value less the trailing value.
    """
    month_end = month_end_of_index(F.lit(before))
    return state.select(
        "customer_key",
        F.inline(
            F.array(
                _change(
                    F.lit(before),
                    orders=F.col("cumulative_orders_to_date"),
                    gain_c=F.col("cumulative_net_c"),
                    loss_c=F.col("cumulative_net_c") - F.col("rolling_12mo_c"),
                    last_order=F.date_sub(month_end, F.col("recency_days")),
                    first_m=F.lit(before) - F.col("months_since_first_purchase"),
                )
            )
        ),
    )


def customer_monthly_snapshot(
    customers: DataFrame,
    orders: DataFrame,
    returns: DataFrame,
    horizon: dt.date,
    since: dt.date | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Rows as ``Star.snapshot`` states them.

    ``customers``: customer_key, signup_date. ``orders``: customer_key,
    order_date, net_c. ``returns``: customer_key, return_date, refund_c. An
    order counts by its own date and a refund by the return's date.

    With ``since`` only the months from that day's on are made. ``state`` then
    is the snapshot's month before, which stands for all events up to it;
    orders and returns are needed from ``first_day_needed(since)`` on.
    """
    end = horizon.year * 12 + horizon.month - 1
    before = None if since is None else since.year * 12 + since.month - 2
    signup = month_index(F.col("signup_date"))
    # Of customers there before, the state's month is where their rows begin.
    at = signup if before is None else F.greatest(signup, F.lit(before))
    signups = customers.select("customer_key", F.inline(F.array(_change(at, signup_date=F.col("signup_date")))))
    events = _order_changes(orders).unionByName(_return_changes(returns))
    if before is not None:
        # Earlier events are in the state; what they do from here on (a window's end, a year's) is not.
        events = events.filter(F.col("m") > before).unionByName(_state_changes(state, before))
    changes = (
        signups.unionByName(events)
        .filter(F.col("m") <= end)
        .groupBy("customer_key", "m")
        .agg(
            *[F.sum(c).alias(c) for c in ("orders", "gain_c", "loss_c", "short", "long")],
            F.max("last_order").alias("last_order"),
            F.min("first_m").alias("first_m"),
            F.max("signup_date").alias("signup_date"),
        )
    )
    # At most one row per customer and month reaches these windows.
    whole = Window.partitionBy("customer_key")
    to_date = whole.orderBy("m").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = changes.select(
        "customer_key",
        "m",
        "short",
        "long",
        F.max("signup_date").over(whole).alias("signup_date"),
        F.sum("orders").over(to_date).alias("cumulative_orders_to_date"),
        F.sum("gain_c").over(to_date).alias("cumulative_net_c"),
        F.sum(F.col("gain_c") - F.col("loss_c")).over(to_date).alias("rolling_12mo_c"),
        F.max("last_order").over(to_date).alias("last_order"),
        F.min("first_m").over(to_date).alias("first_m"),
        F.lead("m", 1, end + 1).over(whole.orderBy("m")).alias("next_m"),
    )
    start = F.greatest("m", signup) if before is None else F.greatest("m", signup, F.lit(before + 1))
    filled = running.filter(start < F.col("next_m")).withColumn(
        "month_no", F.explode(F.sequence(start, F.col("next_m") - 1))
    )
    here = F.col("month_no") == F.col("m")
    month_end = month_end_of_index(F.col("month_no"))
    recency = F.datediff(month_end, "last_order")
    return filled.select(
        "customer_key",
        month_end.alias("month_end"),
        F.datediff(month_end, "signup_date").alias("customer_age_days"),
        (F.col("month_no") - F.col("first_m")).alias("months_since_first_purchase"),
        recency.alias("recency_days"),
        F.when(here, F.col("short")).otherwise(0).alias("orders_last_30_days"),
        F.when(here, F.col("long")).otherwise(0).alias("orders_last_90_days"),
        "cumulative_orders_to_date",
        "cumulative_net_c",
        "rolling_12mo_c",
        F.coalesce(recency <= ACTIVE_DAYS, F.lit(False)).alias("is_active_flag"),
        (F.col("cumulative_orders_to_date") >= 2).alias("is_repeat_customer_flag"),
        F.coalesce((recency > RISK_DAYS) & (recency <= ACTIVE_DAYS), F.lit(False)).alias("churn_risk_flag"),
    )


def first_day_needed(since: dt.date) -> dt.date:
    """The first day whose events bear on the months from ``since`` on, beside what the month before holds."""
    return dt.date(since.year - 1, since.month, 1)
