"""Events against windows: the cut into blocks, the join, and the jobs that run through it against their exploded forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from merchlens.operators import calendar as cal
from merchlens.operators import quality as q
from merchlens.operators.interval_join import blocks_of, interval_join
from merchlens.operators.snapshot import TRAILING_MONTHS
from merchlens.plans.quality import _refund_months
from merchlens.functions.dates import month_index

D = dt.date


def test_blocks_cover_a_window_once(spark):
    rng = random.Random(3)
    spans = [(a, a + n) for a in (-9, -1, 0, 1, 5, 8) for n in range(0, 40)] + [(3, 2), (0, 10**6), (-(10**15), 10**15)]
    spans += [(a, a + rng.randrange(5000)) for a in (rng.randrange(-(10**6), 10**6) for _ in range(60))]
    df = spark.createDataFrame(spans, "a bigint, b bigint")
    for a, b, blocks in df.select("a", "b", blocks_of(F.col("a"), F.col("b"))).collect():
        pieces = sorted((r.block << r.level, (r.block + 1) << r.level) for r in blocks)
        if b < a:
            assert pieces == []
            continue
        assert pieces[0][0] == a and pieces[-1][1] == b + 1
        assert all(x[1] == y[0] for x, y in zip(pieces, pieces[1:]))
        assert len(pieces) <= 2 * (b - a + 1).bit_length()


@pytest.mark.parametrize("kind", ["bigint", "date"])
def test_join_equals_brute_force(spark, kind):
    rng = random.Random(5)

    def place(n):
        return None if n is None else (n if kind == "bigint" else D(2000, 1, 1) + dt.timedelta(days=n))

    # One key holds most events and windows; some windows are very long, some empty, some null.
    keys = ["hot"] * 8 + ["cold", None]
    events = [(i, rng.choice(keys), place(rng.choice([rng.randrange(-200, 400), None, 7]))) for i in range(400)]
    windows = []
    for i in range(150):
        a = rng.randrange(-200, 400)
        windows.append((i, rng.choice(keys), place(a), place(a + rng.choice([-1, 0, 1, 6, 30, 900]))))
    windows += [(900, "hot", None, place(5)), (901, "hot", place(5), None), windows[0]]
    events.append(events[0])
    e = spark.createDataFrame(events, f"event int, k string, at {kind}").repartition(4)
    w = spark.createDataFrame(windows, f"window int, k string, first {kind}, last {kind}").repartition(3)
    got = sorted((r.event, r.window) for r in interval_join(e, w, "at", "first", "last", ["k"]).collect())

    def holds(x, y, same):
        return None not in (x[2], y[2], y[3]) and y[2] <= x[2] <= y[3] and (not same or (x[1] is not None and x[1] == y[1]))

    assert got == sorted((x[0], y[0]) for x in events for y in windows if holds(x, y, True))
    loose = sorted((r.event, r.window) for r in interval_join(e.drop("k"), w.drop("k"), "at", "first", "last").collect())
    assert loose == sorted((x[0], y[0]) for x in events for y in windows if holds(x, y, False))
    with pytest.raises(ValueError, match="both sides"):
        interval_join(e, w.withColumn("EVENT", F.lit(1)), "at", "first", "last", ["k"])
    assert interval_join(e, w.limit(0), "at", "first", "last", ["k"]).collect() == []


def test_campaign_days_equal_the_exploded_windows(star):
    days = star.calendar()
    by_join = cal.campaign_days(days, star.campaigns())
    exploded = cal.campaign_day_map(star.campaigns()).join(days.select("full_date"), "full_date", "left_semi").select(*by_join.columns)
    assert by_join.count() == exploded.count() > 0 and by_join.exceptAll(exploded).count() == 0


def test_explained_negatives_equal_the_exploded_months(spark, star):
    snap = star.snapshot().select("customer_key", "month_end", "rolling_12mo_c")
    # Every month as if negative, so that many are explained and many are not.
    snap = snap.withColumn("rolling_12mo_c", F.lit(-1))
    refunds, month = _refund_months(star), month_index(F.col("month_end"))
    row = q.explained_negatives(snap, refunds, month, TRAILING_MONTHS).first()
    exploded = (
        refunds.select("customer_key", "order_m", F.explode(F.sequence(F.col("return_m"), F.col("return_m") + TRAILING_MONTHS - 1)).alias("m"))
        .filter(F.col("order_m") <= F.col("m") - TRAILING_MONTHS).select("customer_key", "m").distinct()
    )
    left = snap.select("customer_key", month.alias("m")).join(exploded, ["customer_key", "m"], "left_anti").count()
    assert (row.negative_rows, row.unexplained) == (snap.count(), left) and 0 < left < row.negative_rows


def test_near_orders_equal_the_one_by_one_count(spark):
    from merchlens.operators.snapshot_check import dense_snapshot

    rng = random.Random(2)
    signup, horizon = D(2023, 1, 15), D(2024, 3, 31)
    orders = [(i % 3, signup + dt.timedelta(days=rng.randrange(400)), 100) for i in range(60)]
    customers = spark.createDataFrame([(k, signup) for k in range(4)], "customer_key bigint, signup_date date")
    rows = dense_snapshot(
        customers,
        spark.createDataFrame(orders, "customer_key bigint, order_date date, net_c bigint"),
        spark.createDataFrame([], "customer_key bigint, return_date date, refund_c bigint"),
        horizon,
    ).collect()
    assert len(rows) == 4 * 15
    for r in rows:
        ages = [(r.month_end - d).days for k, d, _ in orders if k == r.customer_key and d <= r.month_end]
        assert r.orders_last_30_days == sum(a < 30 for a in ages) and r.orders_last_90_days == sum(a < 90 for a in ages)


def test_unfolded_months_do_not_go_through_the_driver(spark):
    from merchlens.operators.snapshot_check import dense_snapshot

    # Spark knows these to be small.
    people = spark.range(1).selectExpr("id AS customer_key", "DATE'2024-01-05' AS signup_date")
    orders = spark.range(1).selectExpr("id AS customer_key", "DATE'2024-01-07' AS order_date", "100L AS net_c")
    back = spark.range(1).selectExpr("id AS customer_key", "DATE'2024-02-01' AS return_date", "10L AS refund_c")
    rows = dense_snapshot(people, orders, back, D(2024, 6, 30))
    plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    joins = [line for line in plan if "Join" in line and "_level" in line]
    assert joins and not [line for line in joins if "Broadcast" in line]
