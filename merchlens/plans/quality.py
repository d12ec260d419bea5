"""The data-quality operators run over whole tables, by what ``specs`` says must hold of them.

Raw tables carry real violations; the star built from them must carry none.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.dates import month_index
from merchlens.functions.money import cents, currency, exact_round, pct, ratio
from merchlens.operators import quality as q
from merchlens.operators.snapshot import TRAILING_MONTHS
from merchlens.operators.snapshot_check import dense_snapshot
from merchlens.params import Params
from merchlens.plans.ledger import Ledger
from merchlens.plans.specs import RAW, Specs, stored
from merchlens.session import stage
from merchlens.sources.retail import RetailStar
from merchlens.sources.star import Star

# What the calendar says of some days.
SPOT_DAYS = {
    "1996-02-29": {"day_name": "Thursday", "season": "Winter", "holiday_flag": "false", "week_of_year": "9"},
    "1999-11-25": {"day_name": "Thursday", "holiday_flag": "true", "campaign_period_flag": "true"},
    "2000-01-01": {"day_of_week": "6", "is_weekend": "true", "week_of_year": "52", "holiday_flag": "true"},
    "2000-09-04": {"day_name": "Monday", "holiday_flag": "true", "fiscal_quarter": "3"},
}


def _specs(star: Star) -> Specs:
    """What must hold of the tables that a star keeps: raw ones, or its own twelve."""
    return RAW if isinstance(star, RetailStar) else stored()


def _table(star: Star, name: str) -> DataFrame:
    return star.raw(name) if isinstance(star, RetailStar) else star.table(name)


def dq_fk_orphans(star: Star, params: Params) -> DataFrame:
    rows = _specs(star).relations
    return q.union_all([q.fk_orphans(_table(star, c), fk, _table(star, p), pk, f"{c}.{fk}") for c, fk, p, pk in rows])


def dq_pk_unique(star: Star, params: Params) -> DataFrame:
    return q.union_all([q.pk_unique(_table(star, t), k, t) for t, k in _specs(star).keys])


def dq_grain_unique(star: Star, params: Params) -> DataFrame:
    return q.union_all([q.grain_unique(_table(star, t), g, f"{t}({','.join(g)})") for t, g in _specs(star).grains])


def dq_not_null(star: Star, params: Params) -> DataFrame:
    return q.union_all([q.not_null(_table(star, t), cols or _table(star, t).columns, t) for t, cols in _specs(star).not_null.items()])


def dq_domain_values(star: Star, params: Params) -> DataFrame:
    return q.union_all([q.domain_values(_table(star, t), c, v, f"{t}.{c}") for (t, c), v in _specs(star).domains.items()])


def dq_pattern(star: Star, params: Params) -> DataFrame:
    return q.union_all([q.pattern(_table(star, t), c, r, f"{t}.{c}") for (t, c), r in _specs(star).patterns.items()])


def dq_prefix_domain(star: Star, params: Params) -> DataFrame:
    """Values allowed by the beginning of another column, by the longest prefix that a rule names."""
    rows = []
    for (table, name, value), rules in _specs(star).prefixes.items():
        frame = star.spark.createDataFrame(list(rules.items()), "prefix string, allowed array<string>")
        df = _table(star, table).select(F.col(name), F.col(value).cast("string").alias(value))
        rows.append(q.prefix_domain(df, name, value, frame, f"{table}.{value} by {name}"))
    return q.union_all(rows)


def dq_row_rule(star: Star, params: Params) -> DataFrame:
    return q.union_all([q.row_rules(_table(star, t), rules, t) for t, rules in _specs(star).row_rules().items()])


def dq_cross_table_rule(star: Star, params: Params) -> DataFrame:
    rows = []
    for child, parent, key, parent_key, rules in _specs(star).cross_rules():
        other = _table(star, parent).withColumnRenamed(parent_key, key)
        # The parent's columns that the child has too are the child's.
        other = other.drop(*[c for c in other.columns if c != key and c in _table(star, child).columns])
        rows.append(q.cross_table_rules(_table(star, child), other, key, rules, f"{child}-{parent}"))
    return q.union_all(rows)


def dq_reconcile_groups(star: Star, params: Params) -> DataFrame:
    """Headers against lines, and, where raw tables state order totals, those against their lines."""
    headers = star.orders("order_key", "net_c").withColumnRenamed("net_c", "amount")
    lines = star.order_line_totals().select("order_key", F.col("net_c").alias("amount"))
    of_star = q.reconcile_groups(headers, lines, "order_key", "amount", 1, "header net")
    if not isinstance(star, RetailStar):
        return of_star
    stated = star.raw("orders").select(
        F.col("o_orderkey").alias("order_key"), cents(F.col("o_totalprice")).alias("amount")
    )
    raw_lines = star.raw("lineitem").select(
        F.col("l_orderkey").alias("order_key"), cents(F.col("l_extendedprice")).alias("amount")
    )
    return q.reconcile_groups(stated, raw_lines, "order_key", "amount", 1, "raw total").unionByName(of_star)


def dq_reconcile_totals(star: Star, params: Params) -> DataFrame:
    """Net revenue after returns from headers, from lines and from the snapshot."""
    refunds = star.returns("refund_c").agg(F.sum("refund_c").alias("r")).scalar()

    def less(df: DataFrame) -> DataFrame:
        return df.agg((F.sum("net_c") - F.coalesce(refunds, F.lit(0))).alias("total"))

    last = star.snapshot().filter(F.col("month_end") == F.lit(star.horizon))
    rows = q.reconcile_totals(
        {
            "headers": less(star.orders("net_c")),
            "lines": less(star.lines("net_c")),
            "snapshot": last.agg(F.sum("cumulative_net_c").alias("total")),
        },
        5,
    )
    return rows.withColumn("total", currency(F.col("total")))


def dq_series_continuity(star: Star, params: Params) -> DataFrame:
    """Every customer's months from signup to the horizon, and the calendar's days."""
    end = F.lit(star.horizon)
    months = star.snapshot().select("customer_key", "month_end").join(
        star.customers("customer_key", "signup_date"), "customer_key"
    )
    snap = q.series_continuity(
        months,
        "customer_key",
        month_index(F.col("month_end")),
        month_index(F.col("signup_date")),
        month_index(end),
    )
    origin = F.lit(star.calendar_start)
    days = q.series_continuity(
        star.calendar().withColumn("one", F.lit(1)),
        "one",
        F.datediff("full_date", origin),
        F.lit(0),
        F.datediff(end, origin),
    )
    return snap.select(F.lit("customer months").alias("series_of"), "*").unionByName(
        days.select(F.lit("calendar days").alias("series_of"), "*")
    )


def dq_monotonic(star: Star, params: Params) -> DataFrame:
    return q.monotonic(
        star.snapshot(),
        "customer_key",
        "month_end",
        {"cumulative_orders_to_date": False, "customer_age_days": True, "cumulative_net_c": False},
    )


def dq_schema_shape(star: Star, params: Params) -> DataFrame:
    declared = _specs(star).schema
    return q.schema_shape(star.spark, {t: _table(star, t) for t in declared}, declared)


def dq_row_count(star: Star, params: Params) -> DataFrame:
    return q.union_all([q.row_count(_table(star, t), n, t) for t, n in _specs(star).minimum_rows.items()])


def dq_dense_key(star: Star, params: Params) -> DataFrame:
    specs = _specs(star)
    return q.union_all([q.dense_key(_table(star, t), k, specs.first_key, f"{t}.{k}") for t, k in specs.dense])


def dq_distribution(star: Star, params: Params) -> DataFrame:
    return q.union_all(
        [q.distribution(_table(star, t), c, goal, tol, f"{t}.{c}") for (t, c), (goal, tol) in _specs(star).distributions.items()]
    )


def dq_key_coverage(star: Star, params: Params) -> DataFrame:
    rows = _specs(star).coverage
    return q.union_all([q.key_coverage(_table(star, p), pk, _table(star, c), fk, f"{p} without {c}") for p, pk, c, fk in rows])


def dq_date_range(star: Star, params: Params) -> DataFrame:
    low, high = F.lit(star.calendar_start), F.lit(star.horizon)
    rows = [q.date_range(_table(star, t), c, low, high, f"{t}.{c}") for t, c in _specs(star).dates]
    rows.append(q.date_range(star.orders("order_date"), "order_date", low, high, "fact_orders.order_date"))
    rows.append(q.date_range(star.returns("return_date"), "return_date", low, high, "fact_returns.return_date"))
    return q.union_all(rows)


def dq_rederive_snapshot(star: Star, params: Params) -> DataFrame:
    """Both derivations leave their months dealt by customer, so they are compared where they are made."""
    star.hold_facts(orders=True)
    again = dense_snapshot(
        star.customers("customer_key", "signup_date"),
        star.orders("customer_key", "order_date", "net_c"),
        star.returns("customer_key", "return_date", "refund_c"),
        star.horizon,
    )
    measures = [c for c in again.columns if c not in ("customer_key", "month_end")]
    return stage(q.disagreements(star.snapshot(), again, ["customer_key", "month_end"], measures), "disagreements", lean=True)


def _refund_months(star: Star) -> DataFrame:
    orders = star.orders("order_key", "order_date")
    return (
        star.returns("order_key", "customer_key", "return_date")
        .join(orders, "order_key")
        .select(
            "customer_key",
            month_index(F.col("order_date")).alias("order_m"),
            month_index(F.col("return_date")).alias("return_m"),
        )
        .distinct()
    )


def dq_explained_negatives(star: Star, params: Params) -> DataFrame:
    snap = star.snapshot().select("customer_key", "month_end", "rolling_12mo_c")
    return q.explained_negatives(snap, _refund_months(star), month_index(F.col("month_end")), TRAILING_MONTHS)


def dq_two_source_month(star: Star, params: Params) -> DataFrame:
    """The first purchase month by the order flag and by the snapshot."""
    by_order = (
        star.orders("customer_key", "order_date", "is_first_order")
        .filter("is_first_order")
        .select("customer_key", F.last_day("order_date").alias("first_month"))
    )
    by_snapshot = (
        star.snapshot()
        .filter("months_since_first_purchase = 0")
        .select("customer_key", F.col("month_end").alias("first_month"))
    )
    return q.disagreements(by_order, by_snapshot, ["customer_key"], ["first_month"])


def _claim(df: DataFrame, check: str, name: str, value: Column, holds: Column, otherwise: str = q.FAIL) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        F.lit(name).alias("claim"),
        value.cast("string").alias("evidence"),
        F.when(holds, q.PASS).otherwise(otherwise).alias("status"),
    )


def claims(monthly: DataFrame, refunds: DataFrame, sold: DataFrame, params: Params) -> DataFrame:
    """What is said about the business, each with the id of its check.

    ``monthly``: customer_key, month (index), orders, net_c. ``refunds``: month, refund_c. ``sold``: category, units,
    back. ``monthly`` is read three times, so it should be a stored table.
    """
    per_customer = monthly.groupBy("customer_key").agg((F.sum("orders") >= 2).alias("again"))
    by_month = monthly.groupBy("month").agg(F.sum("net_c").alias("net_c"))
    year = F.floor(F.col("month") / 12)
    # Few rows from here on: one per year, month or category.
    by_year = by_month.groupBy(year.alias("year")).agg(F.sum("net_c").alias("net_c"))
    falls = by_year.select((F.col("net_c") <= F.lag("net_c").over(Window.orderBy("year"))).alias("f")).agg(
        F.count_if("f").alias("falls")
    )
    holiday = F.col("month") % 12 >= 10
    peak = by_month.agg(
        F.avg(F.when(holiday, F.col("net_c"))).alias("peak"), F.avg(F.when(~holiday, F.col("net_c"))).alias("rest")
    )
    negative = by_month.join(refunds, "month", "left").agg(
        F.count_if(F.col("net_c") < F.coalesce("refund_c", F.lit(0))).alias("n")
    )
    rate = ratio(F.coalesce("back", F.lit(0)), F.col("units"))
    worst = sold.agg(F.max_by("category", F.struct(rate, F.col("category"))).alias("category"))
    repeat = (
        monthly.join(per_customer, "customer_key")
        .groupBy(year.alias("year"))
        .agg(F.sum("net_c").alias("net_c"), F.sum(F.when(F.col("again"), F.col("net_c")).otherwise(0)).alias("again_c"))
    )
    share = repeat.agg(F.sum("again_c").alias("again_c"), F.sum("net_c").alias("net_c"))
    trend = repeat.select(
        (
            ratio(F.col("again_c"), F.col("net_c"))
            <= F.lag(ratio(F.col("again_c"), F.col("net_c"))).over(Window.orderBy("year"))
        ).alias("f")
    ).agg(F.count_if("f").alias("falls"))
    return q.union_all(
        [
            _claim(falls, "5.1", "revenue grows every year", F.col("falls"), F.col("falls") == 0),
            _claim(
                peak,
                "5.2",
                "November and December beat the other months",
                exact_round(F.col("peak") / F.col("rest"), 3),
                F.col("peak") > F.col("rest"),
            ),
            _claim(negative, "5.3", "no month has negative net revenue", F.col("n"), F.col("n") == 0),
            _claim(
                worst,
                "5.4",
                "the expected category has the highest return rate",
                F.col("category"),
                F.col("category") == params.high_return_category,
            ),
            _claim(
                share,
                "5.5",
                "repeat customers bring a minority of revenue",
                pct(F.col("again_c"), F.col("net_c"), 2),
                F.col("again_c") * 2 < F.col("net_c"),
                q.FINDING,
            ),
            _claim(trend, "5.6", "the repeat share grows every year", F.col("falls"), F.col("falls") == 0, q.FINDING),
        ]
    )


def dq_narrative(star: Star, params: Params) -> DataFrame:
    """What is said about the business, checked against the facts, each of which is read once."""
    monthly = stage(
        star.orders("customer_key", "order_date", "net_c")
        .groupBy("customer_key", month_index(F.col("order_date")).alias("month"))
        .agg(F.count("*").alias("orders"), F.sum("net_c").alias("net_c")),
        "customer-months",
    )
    back = stage(
        star.returns("product_key", "return_date", "refund_c", "return_quantity")
        .groupBy("product_key", month_index(F.col("return_date")).alias("month"))
        .agg(F.sum("refund_c").alias("refund_c"), F.sum("return_quantity").alias("back")),
        "product-months",
    )
    refunds = back.groupBy("month").agg(F.sum("refund_c").alias("refund_c"))
    of_product = back.groupBy("product_key").agg(F.sum("back").alias("back"))
    sold = (
        star.product_totals("category")
        .select("product_key", "category", "units")
        .join(of_product, "product_key", "left")
        .groupBy("category")
        .agg(F.sum("units").alias("units"), F.sum("back").alias("back"))
    )
    return claims(monthly, refunds, sold, params).drop("check")


def _ready(*rows: tuple[str, str, Column, Column]) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(check).alias("check"),
                    F.lit(name).alias("requirement"),
                    measure.cast("bigint").alias("measure"),
                    F.when(ok, q.PASS).otherwise(q.FAIL).alias("status"),
                )
                for check, name, measure, ok in rows
            ]
        )
    )


def readiness(series: DataFrame, signups: DataFrame, months: DataFrame, grains: DataFrame, horizon: dt.date) -> DataFrame:
    """Whether segmentation, cohorts, churn labels and series can be built, each with the id of its check.

    ``series``: one row per customer, as ``Ledger.series`` gives it. ``signups``: signup_date. ``months``: month
    (index) of orders. ``grains``: one row with the counts ``lines`` and ``orders``.
    """
    end = horizon.year * 12 + horizon.month - 1
    bought = F.col("f_orders") > 0

    def one(c: str) -> Column:
        return F.col(c)

    base = series.agg(
        F.count_if(bought & (F.col("f_recency").isNull() | F.col("f_net_c").isNull())).alias("incomplete"),
        F.count_distinct(F.when(bought, F.col("f_recency"))).alias("recencies"),
        F.count_distinct(F.when(bought, F.col("f_net_c"))).alias("amounts"),
        F.count_if(bought & (F.col("f_net_c") > 0)).alias("rankable"),
        F.coalesce(F.sum("labelled"), F.lit(0)).alias("labelled"),
        F.coalesce(F.sum("impossible"), F.lit(0)).alias("impossible"),
        F.coalesce(F.sum("at_risk"), F.lit(0)).alias("at_risk"),
        F.coalesce(F.sum("not_at_risk"), F.lit(0)).alias("not_at_risk"),
    ).select(
        _ready(
            ("6.1", "rfm inputs complete", one("incomplete"), one("incomplete") == 0),
            ("6.2", "recency can be cut in five", one("recencies"), one("recencies") >= 5),
            ("6.2", "value can be cut in five", one("amounts"), one("amounts") >= 5),
            ("6.4", "churn labels can be derived", one("labelled"), one("labelled") > 0),
            ("6.4", "no label beyond the horizon", one("impossible"), one("impossible") == 0),
            ("6.5", "both churn classes occur", F.least("at_risk", "not_at_risk"), (one("at_risk") > 0) & (one("not_at_risk") > 0)),
            ("6.6", "enough customers to rank", one("rankable"), one("rankable") >= 100),
        )
    )
    sizes = signups.groupBy(F.trunc("signup_date", "MM").alias("m")).agg(F.count("*").alias("n")).agg(F.min("n").alias("smallest"))
    dead = months.distinct().agg((F.lit(end) - F.min("month") + 1 - F.count("*")).alias("dead"))
    return q.union_all(
        [
            base,
            sizes.select(_ready(("6.3", "every cohort has customers", one("smallest"), one("smallest") > 0))),
            dead.select(_ready(("6.7", "no month without orders", one("dead"), one("dead") == 0))),
            grains.select(_ready(("6.8", "lines fan out of orders", one("lines") - one("orders"), one("lines") > one("orders")))),
        ]
    )


def dq_analytics_readiness(star: Star, params: Params) -> DataFrame:
    """Whether segmentation, cohorts, churn labels and series can be built; the snapshot is read once."""
    series = stage(Ledger(star).series, "series")
    orders = stage(
        star.order_line_totals().select("order_key", "lines")
        .join(star.orders("order_key", "order_date"), "order_key")
        .groupBy(month_index(F.col("order_date")).alias("month"))
        .agg(F.sum("lines").alias("lines"), F.count("*").alias("orders")),
        "order-months",
    )
    grains = orders.agg(F.sum("lines").alias("lines"), F.sum("orders").alias("orders"))
    return readiness(series, star.customers("signup_date"), orders.select("month"), grains, star.horizon).drop("check")


def dq_spot_row(star: Star, params: Params) -> DataFrame:
    return q.spot_rows(star.calendar(), "full_date", SPOT_DAYS)


# Schema shapes come from footers and spot rows from the generated calendar; neither reads a
# table's rows, so both are functions for a star and no queries of their own.
OPERATORS = {
    f.__name__: f
    for f in (
        dq_fk_orphans, dq_pk_unique, dq_grain_unique, dq_not_null, dq_domain_values, dq_pattern, dq_row_rule,
        dq_cross_table_rule, dq_reconcile_groups, dq_reconcile_totals, dq_series_continuity, dq_monotonic,
        dq_prefix_domain, dq_row_count, dq_dense_key, dq_distribution, dq_key_coverage, dq_date_range,
        dq_rederive_snapshot, dq_explained_negatives, dq_two_source_month, dq_narrative, dq_analytics_readiness,
    )
}
