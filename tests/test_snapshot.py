"""The snapshot against a plain day-by-day derivation on edge rows."""

import calendar
import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from merchlens import RetailStar, StoredStar
from merchlens.operators import quality as q
from merchlens.operators.snapshot import customer_monthly_snapshot, first_day_needed
from merchlens.operators.snapshot_check import dense_snapshot
from merchlens.session import scratch_path
from merchlens.sources import append, versions
from merchlens.sources.publish import publish_months, publish_star, publish_table
from merchlens.sources.star import stored_snapshot

D = dt.date
HORIZON = D(2025, 6, 30)


def month_ends(first, last):
    y, m = first.year, first.month
    while (y, m) <= (last.year, last.month):
        yield D(y, m, calendar.monthrange(y, m)[1])
        y, m = (y, m + 1) if m < 12 else (y + 1, 1)


def brute(customers, orders, returns):
    rows = {}
    for c, signup in customers:
        mine = sorted((d, v) for k, d, v in orders if k == c)
        back = [(d, v) for k, d, v in returns if k == c]
        for end in month_ends(signup, HORIZON):
            seen = [(d, v) for d, v in mine if d <= end]
            gone = [(d, v) for d, v in back if d <= end]
            start = D(end.year - 1, end.month, 1)
            start = D(start.year + (start.month == 12), start.month % 12 + 1, 1)
            recency = (end - seen[-1][0]).days if seen else None
            rows[c, end] = dict(
                customer_age_days=(end - signup).days,
                months_since_first_purchase=(
                    (end.year - seen[0][0].year) * 12 + end.month - seen[0][0].month if seen else None
                ),
                recency_days=recency,
                orders_last_30_days=sum((end - d).days < 30 for d, _ in seen),
                orders_last_90_days=sum((end - d).days < 90 for d, _ in seen),
                cumulative_orders_to_date=len(seen),
                cumulative_net_c=sum(v for _, v in seen) - sum(v for _, v in gone),
                rolling_12mo_c=sum(v for d, v in seen if d >= start) - sum(v for d, v in gone if d >= start),
                is_active_flag=recency is not None and recency <= 90,
                is_repeat_customer_flag=len(seen) >= 2,
                churn_risk_flag=recency is not None and 60 < recency <= 90,
            )
    return rows


def frames(spark, customers, orders, returns):
    return (
        spark.createDataFrame(customers, "customer_key bigint, signup_date date"),
        spark.createDataFrame(orders, "customer_key bigint, order_date date, net_c bigint"),
        spark.createDataFrame(returns, "customer_key bigint, return_date date, refund_c bigint"),
    )


def edge_rows():
    rnd = random.Random(7)
    end = D(2025, 3, 31)
    customers = [(1, D(2024, 1, 31)), (2, D(2025, 6, 30)), (3, D(2024, 2, 29)), (4, D(2023, 1, 1)), (5, D(2023, 5, 5))]
    # Recency of 60, 61, 90, 91 days and orders 29, 30, 89, 90 days before a month end.
    orders = []
    for i, days in enumerate((60, 61, 90, 91, 29, 30, 89)):
        customers.append((10 + i, D(2024, 1, 1)))
        orders.append((10 + i, end - dt.timedelta(days), 100 + i))
    # A refund whose order has left the trailing year, and two orders on one day.
    orders += [(4, D(2023, 6, 10), 5000), (1, D(2024, 2, 1), 10), (1, D(2024, 2, 1), 20)]
    returns = [(4, D(2024, 6, 20), 5000), (1, D(2024, 2, 20), 30)]
    for c in range(20, 40):
        customers.append((c, D(2023, 1, 1) + dt.timedelta(rnd.randrange(300))))
        for _ in range(rnd.randrange(12)):
            day = customers[-1][1] + dt.timedelta(rnd.randrange(500))
            orders.append((c, day, rnd.randrange(1, 10_000)))
            if rnd.random() < 0.4 and day + dt.timedelta(30) <= HORIZON:
                returns.append((c, day + dt.timedelta(rnd.randrange(5, 30)), rnd.randrange(1, 5_000)))
    return customers, [o for o in orders if o[1] <= HORIZON], returns


def test_snapshot_equals_plain_derivation(spark):
    rows = edge_rows()
    got = customer_monthly_snapshot(*frames(spark, *rows), HORIZON).collect()
    want = brute(*rows)
    assert len(got) == len(want)
    for r in got:
        r = r.asDict()
        assert {k: v for k, v in r.items() if k not in ("customer_key", "month_end")} == want[
            r["customer_key"], r["month_end"]
        ], r
    assert any(r.rolling_12mo_c < 0 for r in got)


def test_both_derivations_agree(spark):
    tables = frames(spark, *edge_rows())
    first, again = customer_monthly_snapshot(*tables, HORIZON), dense_snapshot(*tables, HORIZON)
    measures = [c for c in again.columns if c not in ("customer_key", "month_end")]
    row = q.disagreements(first, again, ["customer_key", "month_end"], measures).first().asDict()
    rows = row.pop("compared_rows")
    assert rows > 500 and not any(row.values())


def test_orders_before_signup_count_from_the_first_row_on(spark):
    rows = [(1, D(2025, 5, 2))], [(1, D(2025, 1, 5), 100)], [(1, D(2025, 4, 5), 40)]
    got = customer_monthly_snapshot(*frames(spark, *rows), HORIZON).collect()
    assert {(r.month_end.month, r.cumulative_orders_to_date, r.cumulative_net_c) for r in got} == {(5, 1, 60), (6, 1, 60)}


def _columns(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_months_from_a_state_equal_a_full_build(spark):
    customers, orders, returns = edge_rows()
    # Only customers whose first row lies in the period or before it; the state stands for all that came before.
    whole = customer_monthly_snapshot(*frames(spark, customers, orders, returns), HORIZON).cache()
    for since in (D(2025, 6, 1), D(2025, 2, 1), D(2024, 3, 1), D(2023, 2, 1)):
        needed = first_day_needed(since)
        last = since - dt.timedelta(days=1)
        recent = [o for o in orders if o[1] >= needed], [r for r in returns if r[1] >= needed]
        state = whole.filter(F.col("month_end") == F.lit(last))
        got = customer_monthly_snapshot(*frames(spark, customers, *recent), HORIZON, since, state)
        assert _columns(got) == _columns(whole.filter(F.col("month_end") > F.lit(last)))


class _Until(RetailStar):
    """The star as it was at a month end, with some late refunds left out."""

    def __init__(self, spark, root, day, without=()):
        super().__init__(spark, root)
        self.day, self.without = day, list(without)

    @property
    def horizon(self):
        return self.day

    def _known(self, df, date):
        return df.filter(F.col(date) <= F.lit(self.day))

    def orders(self, *cols, during=None):
        more = [c for c in ("order_date",) if c not in cols]
        return self._known(super().orders(*cols, *more, during=during), "order_date").select(*cols)

    def returns(self, *cols, during=None):
        more = [c for c in ("return_key", "return_date") if c not in cols]
        rows = self._known(super().returns(*cols, *more, during=during), "return_date")
        return rows.filter(~F.col("return_key").isin(self.without)).select(*cols) if self.without else rows.select(*cols)


def _parts(spark, root):
    """The files of each month that readers see, with their times."""
    seen = {}
    rows = StoredStar(spark, root).table(append.SNAPSHOT).select("month_key", F.input_file_name().alias("f")).distinct().collect()
    for r in rows:
        path = r.f.removeprefix("file://")
        seen.setdefault(r.month_key, set()).add((path, Path(path).stat().st_mtime_ns))
    return seen


def test_a_month_and_a_late_refund_rewrite_what_they_touch(spark, sf_dir):
    now = RetailStar(spark, sf_dir)
    late = now.returns("return_key", "return_date").filter("return_date between '2000-02-01' and '2000-02-29'").orderBy("return_key").first()
    may = dt.date(2000, 5, 31)
    was = _Until(spark, sf_dir, may, [late.return_key])
    root = scratch_path(spark, "append")
    publish_star(was, root, ("dim_date",))
    publish_table(stored_snapshot(was.snapshot()), root, append.SNAPSHOT)
    before = _parts(spark, root)

    # One month more.
    june = _Until(spark, sf_dir, dt.date(2000, 6, 30), [late.return_key])
    assert append.first_changed_month(was, june) == dt.date(2000, 6, 1)
    append.append_months(june, root, dt.date(2000, 6, 1))
    assert _columns(StoredStar(spark, root).snapshot()) == _columns(june.snapshot())
    after = _parts(spark, root)
    assert {m: f for m, f in after.items() if m != 200006} == before and 200006 in after

    # A refund of February comes late.
    whole = _Until(spark, sf_dir, dt.date(2000, 6, 30))
    since = append.first_changed_month(june, whole)
    assert since == dt.date(2000, 2, 1)
    append.append_months(whole, root, since)
    assert _columns(StoredStar(spark, root).snapshot()) == _columns(whole.snapshot())
    last = _parts(spark, root)
    assert {m: f for m, f in last.items() if m < 200002} == {m: f for m, f in before.items() if m < 200002}
    assert all(last[m] != after[m] for m in after if m >= 200002)
    assert append.first_changed_month(whole, whole) is None

    # The version before can still be read, and its months are kept for it.
    table = f"{root}/{append.SNAPSHOT}"
    assert len(versions.collect(spark, table, keep=1, grace_s=0)) >= 0
    assert _columns(StoredStar(spark, root).snapshot()) == _columns(whole.snapshot())
    stored = versions.current(spark, table)
    assert stored.rows == sum(stored.parts.values()) == StoredStar(spark, root).snapshot().count()


def test_append_refuses_what_it_cannot_carry_on(spark, sf_dir):
    star = _Until(spark, sf_dir, dt.date(2000, 5, 31))
    root = scratch_path(spark, "refused")
    publish_star(star, root, ("dim_date",))
    some = star.snapshot().filter("customer_key > 3")
    publish_table(stored_snapshot(some), root, append.SNAPSHOT)
    with pytest.raises(ValueError, match="is not in the stored month"):
        append.append_months(_Until(spark, sf_dir, dt.date(2000, 6, 30)), root, dt.date(2000, 6, 1))
    with pytest.raises(ValueError, match="no months to append to"):
        publish_months(star.calendar(), root, "dim_date", 200006)
    assert StoredStar(spark, root).snapshot().count() == some.count()


def test_derivations_are_compared_where_their_months_are_made(spark, star, monkeypatch):
    from merchlens.params import RETAIL_PARAMS
    from merchlens.plans import quality

    plans = []

    def planned(df, label, lean=False):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(quality, "stage", planned)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        row = quality.dq_rederive_snapshot(star, RETAIL_PARAMS).first().asDict()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert row.pop("compared_rows") > 500 and not any(row.values())
    # Months, and the blocks that they meet windows in, are many times the rows that are dealt out.
    unfolded = [line for line in plans[0].splitlines() if "Exchange" in line and ("month_end" in line or "_level" in line or " month#" in line)]
    assert not unfolded, unfolded


def test_orders_of_one_day_count_each(spark):
    people, day = [(1, D(2025, 1, 3))], D(2025, 4, 20)
    orders, returns = [(1, day, 10), (1, day, 10), (1, D(2025, 3, 25), 5)], [(1, D(2025, 5, 2), 7)]
    last = dense_snapshot(*frames(spark, people, orders, returns), HORIZON).filter(F.col("month_end") == HORIZON).first()
    assert (last.orders_last_30_days, last.orders_last_90_days, last.cumulative_orders_to_date, last.cumulative_net_c) == (0, 2, 3, 18)
