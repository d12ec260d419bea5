"""A star read from its lines upward: lines and returns, orders, customers.

Each level is one pass over a fact with what it must agree with. The pass gives
the violations of all rules on that fact and the sums that the next level needs,
so no fact is read again for a total, a month or a category.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.dates import date_key, month_index
from merchlens.functions.money import half_up_share
from merchlens.operators.checks import Grain, RolledUp, Rule, looked_at
from merchlens.operators.quality import union_all
from merchlens.session import stage
from merchlens.sources.star import Star

_MONEY = ("gross_c", "discount_c", "net_c")


def _differs(a: str, b: str) -> Column:
    return ~F.col(a).eqNullSafe(F.col(b))


def _none(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


class Ledger:
    def __init__(self, star: Star):
        self.star = star

    def _outside(self, day: str) -> Column:
        return ~F.col(day).between(F.lit(self.star.calendar_start), F.lit(self.star.horizon))

    # -- lines and returns ------------------------------------------------------

    @cached_property
    def lines(self) -> RolledUp:
        """Lines with their returns and product."""
        s = self.star
        cols = ("order_line_key", "order_key", "customer_key", "product_key", "order_date", "quantity", *_MONEY, "unit_cost_c")
        back = s.returns(
            "return_key", "order_line_key", "order_key", "customer_key", "product_key", "return_date", "return_quantity", "refund_c"
        )
        for c in ("order_line_key", "order_key", "customer_key", "product_key"):
            back = back.withColumnRenamed(c, f"r_{c}")
        goods = s.products("product_key", "unit_cost", "category").select(
            F.col("product_key").alias("p_key"), (F.col("unit_cost") * 100).cast("bigint").alias("list_cost_c"), "category"
        )
        # A product that is there twice has its lines twice.
        goods = goods.withColumn("p_copy", F.row_number().over(Window.partitionBy("p_key").orderBy("list_cost_c", "category")))
        # Lines and returns meet in the order that both name, by which either may be dealt already.
        copies = Window.partitionBy("order_key", "order_line_key").orderBy("p_copy", "order_date")
        again = (F.row_number().over(copies) > 1) & F.lag("p_copy").over(copies).eqNullSafe(F.col("p_copy"))
        lines = s.lines_with(goods, *cols).withColumn("l_again", again).withColumn("l_there", F.lit(True))
        of_line = Window.partitionBy("r_order_key", "r_order_line_key").orderBy("return_key")
        back = back.withColumn("r_nth", F.row_number().over(of_line))
        same = (F.col("order_line_key") == F.col("r_order_line_key")) & (F.col("order_key") == F.col("r_order_key"))
        first = self._line_pass(lines.join(back, same, "full"))
        strays = first.grain("stray")
        if strays.isEmpty():
            return first
        # Returns without a line in their order: the line may be another order's, where it was counted, or nowhere.
        strays = stage(strays.select(F.explode(F.array_repeat("back", F.col("n").cast("int"))).alias("back")).select("back.*"), "stray-returns", lean=True)
        keys = strays.select(F.col("r_order_line_key").alias("order_line_key")).distinct()
        named = stage(s.lines_with(goods, *cols).join(keys, "order_line_key", "left_semi"), "lines-of-strays", lean=True)
        rows = strays.join(named, F.col("order_line_key") == F.col("r_order_line_key"), "left")
        return first.also(rows.withColumns({"l_there": F.lit(True), "l_again": F.lit(True), "r_nth": F.lit(1)}), "ledger-lines")

    def _line_pass(self, rows: DataFrame) -> RolledUp:
        """Lines beside their returns; a return that has met no line is kept as it is, and counts nowhere yet."""
        # A line with several returns, or that is there twice, is summed once.
        line = F.col("order_line_key").isNotNull() & ~F.col("l_again") & (F.coalesce("r_nth", F.lit(1)) == 1)
        there = F.col("l_there").isNotNull()
        returned = F.col("return_key").isNotNull() & there
        due = half_up_share(F.col("net_c"), F.col("return_quantity"), F.col("quantity"))
        stale = F.col("order_line_key").isNotNull() & (
            (F.abs(F.col("refund_c") - due) > 1)
            | (F.col("return_quantity") > F.col("quantity"))
            | _differs("order_key", "r_order_key")
            | _differs("customer_key", "r_customer_key")
            | _differs("product_key", "r_product_key")
        )
        own, back_key = F.col("order_line_key"), F.col("return_key")
        rules = [
            Rule("0.4", line & self._outside("order_date"), F.concat(F.lit("line "), own)),
            Rule("0.4", returned & self._outside("return_date"), F.concat(F.lit("return "), back_key)),
            Rule("0.5", returned & (F.col("return_date") < F.col("order_date")), back_key),
            Rule("1.3", line & (F.col("unit_cost_c") != F.col("list_cost_c")), own),
            Rule("1.6", returned & stale, back_key),
            Rule("2.3", returned & (F.col("return_quantity") > F.col("quantity")), back_key),
            Rule("3.7", line & (F.col("unit_cost_c").isNull() | (F.col("unit_cost_c") <= 0)), own),
        ]
        sums = {f"l_{c}": F.when(line, F.col(c)) for c in _MONEY} | {
            "l_rows": F.when(line, 1),
            "l_units": F.when(line, F.col("quantity")),
            "l_cost_c": F.when(line, F.col("quantity") * F.col("unit_cost_c")),
            "r_rows": F.when(returned, 1),
            "r_units": F.when(returned, F.col("return_quantity")),
            "refund_c": F.when(returned, F.col("refund_c")),
        }
        grains = [
            Grain(
                "order",
                # A return without its line still counts in the order that it names.
                {"order_key": F.coalesce("order_key", "r_order_key"), "line_customer": F.col("customer_key"), "line_date": F.col("order_date")},
                sums,
                when=there,
            ),
            Grain(
                "stray",
                {"back": F.struct("return_key", "r_order_line_key", "r_order_key", "r_customer_key", "r_product_key", "return_date", "return_quantity", "refund_c")},
                when=~there,
            ),
            Grain("month", {"month": month_index(F.col("return_date"))}, {"refund_c": F.col("refund_c")}, when=returned),
            Grain("category", {"category": F.col("category")}, {k: sums[k] for k in ("l_units", "r_units")}, when=F.col("category").isNotNull()),
        ]
        return RolledUp(rows, rules, grains, "ledger-lines")

    # -- orders -------------------------------------------------------------------

    @cached_property
    def orders(self) -> RolledUp:
        """Orders with the sums of their lines and returns."""
        s = self.star
        orders = s.orders(
            "order_key", "customer_key", "order_date", "geography_key", "campaign_key", "acquisition_channel_key", *_MONEY, "is_first_order"
        )
        below = self.lines.grain("order").withColumnRenamed("order_key", "line_order").drop("n")
        spans = s.campaigns().select(F.col("campaign_key").alias("p_key"), "start_date", "end_date")
        by_order, by_line_order = Window.partitionBy("order_key"), Window.partitionBy("line_order")
        # Counted before they meet, by the key by which they meet; an order that is there twice meets its lines twice.
        orders = orders.withColumn("o_copies", F.count("*").over(by_order)).withColumn("o_nth", F.row_number().over(by_order.orderBy("customer_key", "order_date")))
        # One row per order unless its lines disagree on customer or date.
        below = (
            below.withColumn("of_lines_net_c", F.sum("l_net_c").over(by_line_order))
            .withColumn("of_lines", F.sum("l_rows").over(by_line_order))
            .withColumn("l_nth", F.row_number().over(by_line_order.orderBy("line_customer", "line_date")))
        )
        rows = (
            orders.join(below, F.col("order_key") == F.col("line_order"), "full")
            .withColumn("lines_net_c", F.col("of_lines_net_c") * F.coalesce("o_copies", F.lit(1)))
            .withColumn("lines", F.col("of_lines") * F.coalesce("o_copies", F.lit(1)))
            .join(spans, F.col("campaign_key") == F.col("p_key"), "left")
        )
        order = F.col("order_key").isNotNull() & (F.col("o_nth") == 1) & (F.coalesce("l_nth", F.lit(1)) == 1)
        told = F.col("order_key").cast("string")
        attributed = order & F.col("campaign_key").isNotNull()
        rules = [
            Rule("0.4", order & self._outside("order_date"), F.concat(F.lit("order "), told)),
            Rule(
                "1.4",
                F.col("order_key").isNotNull() & F.col("l_rows").isNotNull()
                & (_differs("customer_key", "line_customer") | _differs("order_date", "line_date")),
                told,
                F.col("l_rows"),
            ),
            Rule("1.5", order & (F.abs(F.col("net_c") - _none("lines_net_c")) > 1), told),
            Rule("1.7", order & ~F.col("order_date").between(F.col("start_date"), F.col("end_date")), told),
            Rule("2.2", order & (_none("lines") == 0), told),
            Rule("2.2", F.col("order_key").isNull() & (_none("l_rows") > 0), F.col("line_order").cast("string"), F.col("l_rows")),
        ]
        sums = {f"o_{c}": F.when(order, F.col(c)) for c in _MONEY}
        sums |= {"o_rows": F.when(order, 1), "o_firsts": F.when(order & F.col("is_first_order"), 1)}
        sums |= {c: F.col(c) for c in self.lines.grains["order"].sums}
        places = {"geography": F.when(order, F.col("geography_key")), "channel": F.when(order, F.col("acquisition_channel_key"))}
        grains = [
            Grain(
                "customer month",
                {"customer_key": F.col("customer_key"), "month": month_index(F.col("order_date"))},
                sums,
                least={"first_day": F.when(order, F.col("order_date")), "first_flagged": F.when(order & F.col("is_first_order"), F.col("order_date"))}
                | {f"least_{k}": c for k, c in places.items()},
                most={f"most_{k}": c for k, c in places.items()},
            ),
            Grain("day", {"order_date": F.col("order_date")}, {"attributed": F.when(attributed, 1)}, when=attributed),
        ]
        return RolledUp(rows, rules, grains, "ledger-orders")

    # -- customers ------------------------------------------------------------------

    @cached_property
    def series(self) -> DataFrame:
        """The snapshot per customer: its months, its last row, and what labels can be derived from it."""
        s = self.star
        snap = s.snapshot().withColumn("m", month_index(F.col("month_end")))
        last = F.col("month_end") == F.lit(s.horizon)
        end = s.horizon.year * 12 + s.horizon.month - 1
        per = snap.groupBy(F.col("customer_key").alias("s_key")).agg(
            F.count("*").alias("s_rows"),
            # As many as the calendar has months.
            F.sort_array(F.collect_list("m")).alias("months"),
            F.min(F.when(F.col("months_since_first_purchase") == 0, F.col("month_end"))).alias("first_bought"),
            F.count_if("churn_risk_flag").alias("at_risk"),
            F.count_if(~F.col("churn_risk_flag")).alias("not_at_risk"),
            F.count_if(self._outside("month_end")).alias("s_outside"),
            F.max(F.when(last, True)).alias("f_there"),
            F.max(F.when(last, F.col("recency_days"))).alias("f_recency"),
            F.max(F.when(last, F.col("cumulative_orders_to_date"))).alias("f_orders"),
            F.max(F.when(last, F.col("cumulative_net_c"))).alias("f_net_c"),
            F.max(F.when(last, F.col("is_repeat_customer_flag"))).alias("f_repeat"),
        )
        # A month is labelled if the row two on is the month two later.
        two_on = F.filter(
            F.when(F.size("months") > 2, F.sequence(F.lit(1), F.size("months") - 2)).otherwise(F.array().cast("array<int>")),
            lambda i: F.element_at("months", i + 2) == F.element_at("months", i) + 2,
        )
        impossible = F.filter(two_on, lambda i: F.element_at("months", i) > end - 2)
        return per.select(
            "*", F.size(two_on).alias("labelled"), F.size(impossible).alias("impossible"), F.element_at("months", 1).alias("first_month")
        ).drop("months")

    @cached_property
    def customers(self) -> DataFrame:
        """One row per customer with orders, returns and the snapshot, stored."""
        g = self.orders.grains["customer month"]
        sold = self.orders.grain("customer month").groupBy(F.col("customer_key").alias("o_key")).agg(
            *[F.sum(c).alias(c) for c in g.sums], *[F.min(c).alias(c) for c in g.least], *[F.max(c).alias(c) for c in g.most]
        )
        who = self.star.customers("customer_key", "signup_date", "home_geography_key", "acquisition_channel_key")
        rows = (
            who.join(sold, F.col("customer_key") == F.col("o_key"), "full")
            .join(self.series, F.coalesce("customer_key", "o_key") == F.col("s_key"), "full")
            .fillna(0, list(g.sums))
        )
        return stage(rows, "ledger-customers", lean=True)

    def customer_checks(self) -> RolledUp:
        there = F.col("customer_key").isNotNull()
        told = F.coalesce("customer_key", "o_key", "s_key").cast("string")
        value = F.col("o_net_c") - F.col("refund_c")
        stale = (
            (F.col("least_geography") != F.col("home_geography_key")) | (F.col("most_geography") != F.col("home_geography_key"))
            | (F.col("least_channel") != F.col("acquisition_channel_key")) | (F.col("most_channel") != F.col("acquisition_channel_key"))
        )
        rules = [
            Rule("0.4", F.col("s_outside") > 0, F.concat(F.lit("customer "), told), F.col("s_outside")),
            Rule("1.1", there & stale, told),
            Rule("1.2", there & (F.col("first_day") < F.col("signup_date")), told),
            Rule("1.10", there & (F.col("first_month") != month_index(F.col("signup_date"))), told),
            Rule("2.5", there & F.col("f_there") & (F.col("o_rows") != F.col("f_orders")), told),
            Rule("2.6", there & F.col("f_there") & (F.abs(value - F.col("f_net_c")) > 1), told),
            Rule("2.8", ~F.last_day("first_flagged").eqNullSafe(F.col("first_bought")), told),
            Rule("4a.1", there & F.col("s_key").isNull(), told),
            Rule("4b.7", there & (F.col("o_rows") == 0), told),
        ]
        sums = {
            "c_rows": F.when(there, 1),
            "c_buyers": F.when(there & (F.col("o_rows") > 0), 1),
            "c_repeat": F.when(there & (F.col("o_rows") > 1), 1),
            "c_value_c": F.when(there, value),
            "o_first_customers": F.when(there & F.col("first_flagged").isNotNull(), 1),
            "f_orders": F.col("f_orders"),
            "f_value_c": F.col("f_net_c"),
            "f_repeat": F.when(F.col("f_repeat"), 1),
            "s_rows": F.col("s_rows"),
        }
        return RolledUp(self.customers, rules, [Grain("all", {}, sums | {c: F.col(c) for c in self.orders.grains["customer month"].sums})], "ledger-totals")

    # -- the calendar -----------------------------------------------------------------

    def calendar_checks(self) -> RolledUp:
        """Days of the calendar, with the campaign orders that fall on them."""
        s = self.star
        days = s.calendar()
        used = self.orders.grain("day").select(F.col("order_date").alias("used"), "attributed")
        # A calendar has few rows, so one task may put its days in order.
        before = F.lag("full_date").over(Window.orderBy("full_date"))
        rows = days.join(used, F.col("full_date") == F.col("used"), "left").withColumn("before", before)
        nulls = sum((F.col(c).isNull().cast("int") for c in days.columns), F.lit(0))
        told = F.col("full_date").cast("string")
        rules = [
            Rule("D.4", nulls > 0, told, nulls),
            Rule("D.5", F.col("date_key") != date_key(F.col("full_date")), told),
            Rule("D.6", F.datediff("full_date", "before") > 1, F.date_add("before", 1).cast("string"), F.datediff("full_date", "before") - 1),
            Rule("1.8", ~F.col("campaign_period_flag") & (F.col("attributed") > 0), told, F.col("attributed")),
        ]
        number = F.unix_date("full_date")
        grain = Grain("all", {}, {"d_rows": F.lit(1)}, least={"d_first": number}, most={"d_last": number})
        return RolledUp(rows, rules, [grain], "ledger-days")

    # -- keys ---------------------------------------------------------------------------

    def key_checks(self, unused: dict[str, str]) -> DataFrame:
        """(check, key, n) for keys that are repeated, dangling or, by ``unused`` (dimension to check), never used."""
        return union_all(self.key_parts(unused))

    def key_parts(self, unused: dict[str, str]) -> list[DataFrame]:
        """The rows of ``key_checks`` in parts: for the keys of lines and returns, of which there are most, and for others.

        A table has one frame for its keys, which are counted per dimension and place of use where they are read. Parts can be
        stored one after the other, so that their keys are not on the disk together.
        """
        s = self.star
        parent = F.lit("")
        grain = F.concat_ws(" ", "customer_key", "month_end")
        tables = {
            "fact_orders": (
                s.orders("order_key", "customer_key", "order_date", "sales_channel_key", "geography_key", "campaign_key", "acquisition_channel_key"),
                [("order", "order_key", parent), ("customer", "customer_key", None), ("day", "order_date", None), ("sales channel", "sales_channel_key", None),
                 ("geography", "geography_key", None), ("campaign", "campaign_key", None), ("channel", "acquisition_channel_key", None)],
            ),
            "fact_order_lines": (
                s.line_keys(),
                [("line", "order_line_key", parent), ("order", "order_key", None), ("customer", "customer_key", None), ("product", "product_key", None),
                 ("day", "order_date", None)],
            ),
            "fact_returns": (
                s.returns("return_key", "order_line_key", "order_key", "customer_key", "product_key", "return_date", "return_reason_key"),
                [("return", "return_key", parent), ("line", "order_line_key", None), ("order", "order_key", None), ("customer", "customer_key", None),
                 ("product", "product_key", None), ("day", "return_date", None), ("reason", "return_reason_key", None)],
            ),
            "fact_customer_monthly_snapshot": (
                s.snapshot().groupBy("customer_key", "month_end").agg(F.count("*").alias("n")).select("*", grain.alias("grain")),
                [("snapshot", "grain", parent), ("customer", "customer_key", None), ("day", "month_end", None)],
            ),
            "dim_customer": (
                s.customers("customer_key", "home_geography_key", "acquisition_channel_key"),
                [("customer", "customer_key", parent), ("geography", "home_geography_key", None), ("channel", "acquisition_channel_key", None)],
            ),
            "dim_product": (s.products("product_key"), [("product", "product_key", parent)]),
            "dim_date": (s.calendar().select("full_date", "date_key"), [("day", "full_date", parent), ("day key", "date_key", parent)]),
            "dim_geography": (s.geography(), [("geography", "geography_key", parent)]),
            "dim_marketing_channel": (s.marketing_channels(), [("channel", "marketing_channel_key", parent)]),
            "dim_sales_channel": (s.sales_channels(), [("sales channel", "sales_channel_key", parent)]),
            "dim_campaign": (s.campaigns(), [("campaign", "campaign_key", parent)]),
            "dim_return_reason": (s.return_reasons(), [("reason", "return_reason_key", parent)]),
        }
        dims = list(dict.fromkeys(d for _, keys in tables.values() for d, _, _ in keys))
        # The columns that refer to a dimension; there are no more of them than facts.
        users = {d: [f"{t}.{c}" for t, (_, keys) in tables.items() for e, c, p in keys if e == d and p is None] for d in dims}
        slots = range(max(len(u) for u in users.values()))
        frames = [(t, r, keys) for t, (rows, keys) in tables.items() for r in (rows if isinstance(rows, list) else [rows])]

        def entries(of: list[str]) -> list[DataFrame]:
            """A row for each key of these dimensions where a table has it."""
            found = []
            for table, rows, keys in frames:
                n = F.col("n").cast("bigint") if "n" in rows.columns else F.lit(1).cast("bigint")
                told = [
                    F.struct(
                        F.lit(dims.index(d)).alias("d"), F.col(c).cast("string").alias("key"),
                        F.lit(-1 if p is not None else users[d].index(f"{table}.{c}")).alias("user"), n.alias("n"),
                    )
                    for d, c, p in keys
                    if d in of and c in rows.columns
                ]
                if told and table == "fact_customer_monthly_snapshot" and "snapshot" in of:
                    # Nothing refers to a customer month, so one that is there once has nothing to tell.
                    told[0] = F.when(F.col("n") > 1, told[0])
                if told:
                    found.append(rows.select(F.inline(F.array(*told))))
            return found

        def uses(slot: int) -> Column:
            return F.col(f"used_{slot}")

        key = F.coalesce("key", F.lit("NULL"))
        surplus = F.when(F.col("key").isNull(), F.col("parents")).otherwise(F.col("parents") - 1)
        repeated = F.when(F.col("dim").isin("order", "line", "return", "snapshot"), F.lit("0.2")).when(F.col("dim") == "day", F.lit("D.3")).when(
            F.col("dim") == "day key", F.lit("D.2")
        )
        twice = (F.col("dim") == "line") & (uses(users["line"].index("fact_returns.order_line_key")) > 1)
        # Products are used by sold lines, reasons by returns, campaigns and sales channels by orders.
        needed = {
            "product": "fact_order_lines.product_key", "campaign": "fact_orders.campaign_key", "channel": "dim_customer.acquisition_channel_key",
            "sales channel": "fact_orders.sales_channel_key", "reason": "fact_returns.return_reason_key", "geography": "dim_customer.home_geography_key",
        }
        idle = F.coalesce(*[F.when(F.col("dim") == d, uses(users[d].index(r)).isNull()) for d, r in needed.items()], F.lit(False)) & (F.col("parents") > 0)
        check_of = F.coalesce(*[F.when(F.col("dim") == d, F.lit(c)) for d, c in unused.items()])

        def entry(check: Column, named: Column, n: Column) -> Column:
            return F.struct(check.alias("check"), named.alias("key"), n.cast("bigint").alias("n"))

        def dangling(slot: int) -> Column:
            facts = {d: u[slot] for d, u in users.items() if len(u) > slot and u[slot].startswith("fact_")}
            rel = F.coalesce(*[F.when(F.col("dim") == d, F.lit(r)) for d, r in facts.items()])
            there = (F.col("parents") == 0) & uses(slot).isNotNull() & rel.isNotNull()
            return F.when(there, entry(F.lit("0.1"), F.concat_ws(" ", rel, key), uses(slot)))

        def broken(of: list[str]) -> DataFrame:
            per = (
                union_all(entries(of))
                # A key that is not there refers to nothing; a parent without one is counted as repeated.
                .filter("d is not null and (key is not null or user = -1)")
                .groupBy("d", "key")
                .agg(
                    F.coalesce(F.sum(F.when(F.col("user") == -1, F.col("n"))), F.lit(0)).alias("parents"),
                    *[F.sum(F.when(F.col("user") == i, F.col("n"))).alias(f"used_{i}") for i in slots],
                )
                .withColumn("dim", F.element_at(F.array(*[F.lit(d) for d in dims]), F.col("d") + 1))
            )
            return (
                # What is there once and used as it should be breaks nothing.
                per.filter((F.col("parents") != 1) | F.col("key").isNull() | twice | idle)
                .select(
                    F.inline(
                        F.array(
                            F.when((F.col("parents") > 0) & (surplus > 0) & repeated.isNotNull(), entry(repeated, F.concat_ws(" ", "dim", key), surplus)),
                            F.when((F.col("dim") == "snapshot") & (surplus > 0), entry(F.lit("0.3"), F.concat_ws(" ", "dim", key), surplus)),
                            F.when(twice, entry(F.lit("0.3"), F.concat_ws(" ", "dim", key), uses(users["line"].index("fact_returns.order_line_key")) - 1)),
                            F.when(idle & check_of.isNotNull(), entry(check_of, key, F.lit(1))),
                            *[dangling(i) for i in slots],
                        )
                    )
                )
                .filter("check is not null")
            )

        most = ["line", "return"]
        return [
            broken(most),
            broken([d for d in dims if d not in most]).unionByName(looked_at(s.spark, ["0.1", "0.2", "0.3", "D.2", "D.3", *unused.values()])),
        ]

    def empty_dimensions(self) -> DataFrame:
        """(check, key, n): dimensions without a row. One row is enough to know."""
        s = self.star
        tables = {
            "dim_date": s.calendar(), "dim_geography": s.geography(), "dim_marketing_channel": s.marketing_channels(),
            "dim_sales_channel": s.sales_channels(), "dim_campaign": s.campaigns(), "dim_return_reason": s.return_reasons(),
            "dim_customer": s.customers("customer_key"), "dim_product": s.products("product_key"),
        }
        rows = [
            df.limit(1).agg((F.count("*") == 0).cast("bigint").alias("n")).select(F.lit("4a.2").alias("check"), F.lit(name).alias("key"), "n")
            for name, df in tables.items()
        ]
        return union_all(rows)
