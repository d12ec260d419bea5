"""Calendar, orders and refunds on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from merchlens.functions.bands import frequency_score, frequency_tier
from merchlens.functions.money import exact_round, half_up_share
from merchlens.operators import calendar as cal
from merchlens.operators import orders as ops

D = dt.date


def test_holidays_fall_on_their_days(spark):
    got = {(r.full_date, r.holiday_name) for r in cal.holiday_calendar(spark, 2023, 2025).collect()}
    assert len(got) == 21
    assert {
        (D(2023, 5, 29), "Memorial Day"),
        (D(2024, 5, 27), "Memorial Day"),
        (D(2023, 9, 4), "Labor Day"),
        (D(2025, 9, 1), "Labor Day"),
        (D(2023, 11, 23), "Thanksgiving"),
        (D(2024, 11, 28), "Thanksgiving"),
        (D(2025, 11, 28), "Black Friday"),
    } <= got


def test_campaign_windows_hang_on_thanksgiving(spark):
    rows = {r.campaign_name: r for r in cal.campaign_windows(spark, 2023, 2025).collect()}
    assert sorted(r.campaign_key for r in rows.values()) == list(range(1, 22))
    friday, monday = rows["Black Friday 2024"], rows["Cyber Monday 2024"]
    assert (friday.start_date, friday.end_date) == (D(2024, 11, 29), D(2024, 12, 1))
    assert (monday.start_date, monday.end_date, monday.season) == (D(2024, 12, 2), D(2024, 12, 2), "Winter")
    assert rows["Spring Collection Launch 2023"].discount_depth == "None"


def test_deepest_discount_wins_then_the_lower_key(spark):
    windows = spark.createDataFrame(
        [
            (1, D(2024, 1, 1), D(2024, 1, 3), "Light"),
            (2, D(2024, 1, 2), D(2024, 1, 4), "Deep"),
            (3, D(2024, 1, 4), D(2024, 1, 5), "Deep"),
        ],
        "campaign_key int, start_date date, end_date date, discount_depth string",
    )
    got = {r.full_date.day: r.campaign_key for r in cal.campaign_day_map(windows).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 2, 5: 3}


def test_calendar_has_leap_day_and_iso_weeks(spark):
    none = spark.createDataFrame([], "full_date date, holiday_name string")
    no_windows = spark.createDataFrame([], "start_date date, end_date date")
    rows = cal.calendar_dimension(spark, D(2024, 1, 1), D(2024, 12, 31), none, no_windows)
    rows = {r.full_date: r for r in rows.collect()}
    assert len(rows) == 366
    last = rows[D(2024, 12, 31)]
    assert (last.week_of_year, last.day_of_week, last.day_name, last.season) == (1, 2, "Tuesday", "Winter")
    assert rows[D(2024, 2, 29)].date_key == 20240229
    assert not last.campaign_period_flag and not last.holiday_flag


def test_attribution_leaves_orders_outside_windows_alone(spark):
    days = spark.createDataFrame(
        [(D(2024, 1, 1), 7, "Deep", 30)],
        "full_date date, campaign_key int, discount_depth string, discount_pct int",
    )
    orders = spark.createDataFrame(
        [(1, D(2024, 1, 1), 1015), (2, D(2024, 1, 2), 1015)], "order_key bigint, order_date date, gross_c bigint"
    )
    got = {r.order_key: (r.campaign_key, r.campaign_discount_c) for r in ops.campaign_attribution(orders, days).collect()}
    assert got == {1: (7, 305), 2: (None, 0)}


def test_discount_split_sums_to_the_header(spark):
    lines = [(1, 1, 333, 10), (1, 2, 333, 10), (1, 3, 335, 10), (2, 1, 999, 45), (3, 1, 5, 10), (3, 2, 5, 10)]
    headers = [(1, 10, 100), (2, 45, 450), (3, 10, 1)]
    got = ops.discount_allocation(
        spark.createDataFrame(lines, "order_key bigint, line bigint, gross_c bigint, discount_pct int"), ["line"]
    ).collect()
    split = {(r.order_key, r.line): r.line_discount_c for r in got}
    for order, _, whole in headers:
        assert sum(v for (o, _), v in split.items() if o == order) == whole
    # 10 % of 333 is 33.3; the last line takes the remainder.
    assert [split[1, i] for i in (1, 2, 3)] == [33, 33, 34]
    # Both halves of one cent round up, so the last line gives back.
    assert [split[3, i] for i in (1, 2)] == [1, 0]


def test_refund_rounds_half_cents_up(spark):
    # 58.51 for two units: one unit is 29.255.
    row = spark.range(1).select(
        half_up_share(F.lit(5851).cast("bigint"), F.lit(1).cast("bigint"), F.lit(2).cast("bigint")).alias("a"),
        half_up_share(F.lit(1).cast("bigint"), F.lit(1).cast("bigint"), F.lit(3).cast("bigint")).alias("b"),
        ops.restocking_fee(F.lit(2926).cast("bigint"), F.lit(4)).alias("fee"),
        ops.restocking_fee(F.lit(2926).cast("bigint"), F.lit(3)).alias("none"),
        ops.refund_completed(F.lit(D(2024, 1, 26)), F.lit(D(2024, 1, 31))).alias("done"),
        ops.refund_completed(F.lit(D(2024, 1, 27)), F.lit(D(2024, 1, 31))).alias("open"),
    ).first()
    assert (row.a, row.b, row.fee, row.none, row.done, row.open) == (2926, 0, 293, 0, True, False)


def test_shipping_is_free_from_exactly_75(spark):
    got = spark.createDataFrame([(7499,), (7500,)], "c bigint").select(ops.shipping(F.col("c")).alias("s")).collect()
    assert [r.s for r in got] == [699, 0]


def test_first_order_goes_to_the_lowest_key_of_the_day(spark):
    rows = [(9, 1, D(2024, 1, 1)), (5, 1, D(2024, 1, 1)), (1, 1, D(2024, 1, 2)), (2, 2, D(2024, 1, 2))]
    df = spark.createDataFrame(rows, "order_key bigint, customer_key bigint, order_date date")
    assert {r.order_key for r in ops.first_order_flag(df).collect() if r.is_first_order} == {5, 2}


def test_rounding_and_bands(spark):
    row = spark.range(1).select(
        *[exact_round(F.lit(x), 2).alias(f"r{i}") for i, x in enumerate((81.695, 1.005, 0.285))]
    ).first()
    assert tuple(row) == (81.7, 1.01, 0.29)
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 4, 6, 7, 11, 12)], "n bigint")
    got = df.select(frequency_tier(F.col("n")).alias("t"), frequency_score(F.col("n")).alias("s")).collect()
    assert [r.s for r in got] == [1, 1, 2, 2, 3, 3, 4, 4, 5]
    assert [r.t[0] for r in got] == ["0", "1", "2", "2", "4", "4", "7", "7", "7"]
