"""A star derived from order, line, customer, part, nation and region tables.

Every order that has lines counts, unless a status is asked for. Lines give the
line fact, lines flagged as returned give the returns fact, and the order header
is the sum of its lines.
Channel keys are computed from channel names, so no join is needed to place an
order or a customer in a channel.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.functions.money import cents, half_up_percent
from merchlens.operators import calendar as cal
from merchlens.operators import orders as ops
from merchlens.operators.customers import buyer_totals
from merchlens.operators.snapshot import ACTIVE_DAYS, customer_monthly_snapshot
from merchlens.session import run_together, stage
from merchlens.sources.star import Period, Star

# The six return reasons.
_REASONS = [
    (1, "WRONG_SIZE", "Wrong Size", True),
    (2, "DEFECTIVE_QUALITY", "Defective/Quality Issue", True),
    (3, "NOT_AS_DESCRIBED", "Not as Described", True),
    (4, "CHANGED_MIND", "Changed Mind", False),
    (5, "LATE_DELIVERY", "Late Delivery", True),
    (6, "OTHER", "Other", False),
]
# A return follows its order after 5 to 21 days.
_LAG_FROM, _LAG_SPREAD = 5, 17


def _name_key(name: str) -> Column:
    """A positive INT key for a short list of names; listing the names fails if two share one."""
    return F.crc32(name).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def _channels(names: DataFrame, key: str, column: str, group: str) -> DataFrame:
    """Channels from a list of names; two names with one key would double every row joined to them, so that raises."""
    clash = F.raise_error(F.concat(F.lit("channel names share a key: "), F.min("channel_name"), F.lit(", "), F.max("channel_name")))
    name = F.when(F.min("channel_name").eqNullSafe(F.max("channel_name")), F.min("channel_name")).otherwise(clash)
    return names.groupBy(_name_key("channel_name").alias(key)).agg(name.alias("channel_name")).withColumn(column, F.lit(group))


class RetailStar(Star):
    def __init__(self, spark: SparkSession, root: str, status: str | None = None):
        """``status`` restricts the star to orders of that status; None takes all."""
        super().__init__(spark)
        self.root, self.status = root.rstrip("/"), status
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A raw table; its files are listed and its footer is read once per star."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._raw[name]

    # -- observed period: three scalars from one pass over two columns ---------

    @cached_property
    def _bounds(self) -> tuple[dt.date, dt.date, dt.date]:
        day = F.to_date("o_orderdate")
        done = day if self.status is None else F.when(F.col("o_orderstatus") == self.status, day)
        return tuple(self.raw("orders").agg(F.min(day), F.min(done), F.last_day(F.max(done))).first())

    @property
    def calendar_start(self) -> dt.date:
        """The first of the month before the first order; no signup is earlier."""
        first = self._bounds[0].replace(day=1)
        return (first - dt.timedelta(days=1)).replace(day=1)

    @property
    def horizon(self) -> dt.date:
        return self._bounds[2]

    @property
    def campaign_years(self) -> tuple[int, int]:
        return self._bounds[1].year, self.horizon.year

    # -- dimensions ------------------------------------------------------------

    def calendar(self) -> DataFrame:
        first, last = self.calendar_start, self.horizon
        return cal.calendar_dimension(
            self.spark, first, last, cal.holiday_calendar(self.spark, first.year, last.year), self.campaigns()
        )

    def campaigns(self) -> DataFrame:
        return cal.campaign_windows(self.spark, *self.campaign_years)

    def return_reasons(self) -> DataFrame:
        return self.spark.createDataFrame(
            _REASONS,
            "return_reason_key int, reason_code string, reason_description string, is_controllable boolean",
        )

    def geography(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("geography_key"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            F.lit(None).cast("string").alias("postal_code"),
        )

    def marketing_channels(self) -> DataFrame:
        names = self.raw("customer").select(F.col("c_mktsegment").alias("channel_name"))
        return _channels(names, "marketing_channel_key", "channel_category", "Segment")

    def sales_channels(self) -> DataFrame:
        names = self.raw("orders").select(F.col("o_orderpriority").alias("channel_name"))
        return _channels(names, "sales_channel_key", "channel_type", "Priority")

    def customers(self, *cols: str) -> DataFrame:
        c = self.raw("customer").withColumnRenamed("c_custkey", "customer_key")
        if "signup_date" in cols:
            first = (
                self.raw("orders")
                .groupBy(F.col("o_custkey").alias("customer_key"))
                .agg(F.to_date(F.min("o_orderdate")).alias("_first"))
            )
            c = c.join(first, "customer_key", "left").withColumn(
                "signup_date",
                F.coalesce(
                    F.date_sub("_first", (F.col("customer_key") % 30).cast("int")), F.lit(self.calendar_start)
                ),
            )
        derived = {
            "customer_id": F.format_string("CUST-%06d", F.col("customer_key")),
            "first_name": F.substring_index("c_name", "#", 1),
            "last_name": F.substring_index("c_name", "#", -1),
            "email": F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")),
            "birth_year": F.lit(None).cast("int"),
            "acquisition_channel_key": _name_key("c_mktsegment"),
            "home_geography_key": F.col("c_nationkey"),
        }
        return c.select(*[derived[x].alias(x) if x in derived else F.col(x) for x in cols])

    def products(self, *cols: str) -> DataFrame:
        derived = {
            "product_key": F.col("p_partkey"),
            "product_id": F.format_string("PRD-%04d", F.col("p_partkey")),
            "product_name": F.col("p_name"),
            "category": F.col("p_type"),
            "subcategory": F.col("p_brand"),
            "gender": F.lit("Unisex"),
            "size": F.col("p_size").cast("string"),
            "color": F.substring_index("p_name", " ", 1),
            "collection_season": F.lit("All Season"),
            "list_price": F.col("p_retailprice").cast("decimal(10,2)"),
            "unit_cost": F.col("p_retailprice").cast("decimal(10,2)"),
            "unit_cost_c": cents(F.col("p_retailprice")),
            "is_active": F.lit(True),
        }
        return self.raw("part").select(*[derived[x].alias(x) for x in cols])

    # -- facts -----------------------------------------------------------------

    def _counted(self, *cols: str, during: Period = None) -> DataFrame:
        derived = {
            "order_key": F.col("o_orderkey"),
            "customer_key": F.col("o_custkey"),
            "order_date": F.to_date("o_orderdate"),
            "sales_channel_key": _name_key("o_orderpriority"),
            "channel_name": F.col("o_orderpriority"),
        }
        orders = self.raw("orders")
        if during is not None:
            # On the stored column, so that the scan skips what lies outside.
            first, last = during
            orders = orders.filter((F.col("o_orderdate") >= F.lit(first)) & (F.col("o_orderdate") < F.lit(last + dt.timedelta(days=1))))
        if self.status is not None:
            orders = orders.filter(F.col("o_orderstatus") == self.status)
        return orders.select(*[derived[x].alias(x) for x in ("order_key", *cols)])

    @cached_property
    def _priced(self) -> DataFrame:
        """All raw lines with their money in cents; unused columns are pruned."""
        return self._derived(self.raw("lineitem"))

    @staticmethod
    def _derived(raw: DataFrame) -> DataFrame:
        """Raw lines, alone or joined, with their keys and their money in cents."""
        money = raw.withColumn("gross_c", cents(F.col("l_extendedprice")))
        percent = cents(F.col("l_discount"))
        return money.withColumn("discount_c", half_up_percent(F.col("gross_c"), percent)).withColumns(
            {
                "net_c": F.col("gross_c") - F.col("discount_c"),
                "quantity": F.col("l_quantity").cast("bigint"),
                "product_key": F.col("l_partkey"),
                "order_key": F.col("l_orderkey"),
                "order_line_key": F.concat_ws(
                    "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("gross_c")
                ),
            }
        )

    def lines(self, *cols: str, during: Period = None) -> DataFrame:
        from_order = [c for c in cols if c in ("customer_key", "order_date")]
        own = [c for c in dict.fromkeys(("order_key", *cols)) if c not in (*from_order, "unit_cost_c")]
        if "unit_cost_c" in cols and "product_key" not in own:
            own.append("product_key")
        strays = self.held.get("strays")
        if strays is not None and not from_order and during is None:
            df = self._priced.filter("order_key is not null").select(*own).join(strays, "order_key", "left_anti")
        else:
            how = "inner" if from_order else "left_semi"
            df = self._priced.select(*own).join(self._counted(*from_order, during=during), "order_key", how)
        if "unit_cost_c" in cols:
            df = df.join(self.products("product_key", "unit_cost_c"), "product_key")
        return df.select(*cols)

    def lines_with(self, goods: DataFrame, *cols: str) -> DataFrame:
        """Lines meet their products first and their orders last, which leaves them dealt by order.

        They travel as they are stored: the columns that a line's key is made of are narrower than the key.
        """
        from_order = [c for c in cols if c in ("customer_key", "order_date")]
        if not from_order:
            return super().lines_with(goods, *cols)
        rows = self.raw("lineitem")
        if "unit_cost_c" in cols:
            costs = self.products("product_key", "unit_cost_c")
            rows = rows.join(costs, rows.l_partkey == costs.product_key).drop("product_key")
        rows = rows.join(goods, F.col("l_partkey") == F.col("p_key"), "left")
        return self._derived(self._with_orders(rows, *from_order)).select(*cols, *goods.columns)

    def _with_orders(self, rows: DataFrame, *attrs: str) -> DataFrame:
        """Raw lines with columns of their orders; others are left out."""
        orders = self._counted(*attrs)
        return rows.join(orders, rows.l_orderkey == orders.order_key).drop("order_key")

    def line_keys(self) -> list[DataFrame]:
        """A line's customer and day are its order's, so lines are counted per order before they meet the orders."""
        # None, unless the table of orders is at fault: an order that is there twice has its lines twice.
        twice = stage(self._counted().groupBy("order_key").agg(F.count("*").alias("n")).filter("n > 1"), "orders-twice", lean=True)
        own = self.lines("order_key", "order_line_key", "product_key").join(twice, "order_key", "left")
        per = self._priced.groupBy("order_key").agg(F.count("*").alias("n")).join(self._counted("customer_key", "order_date"), "order_key")
        return [own.select("order_line_key", "product_key", F.coalesce("n", F.lit(1)).alias("n")), per]

    @staticmethod
    def _returned_units() -> Column:
        q = F.col("quantity")
        half = F.call_function("div", q + 1, F.lit(2).cast("bigint"))
        return F.when(F.col("l_linenumber") % 2 == 1, q).otherwise(half)

    @staticmethod
    def _return_date() -> Column:
        return F.date_add("order_date", (_LAG_FROM + F.col("order_key") % _LAG_SPREAD).cast("int"))

    def returns(self, *cols: str, during: Period = None) -> DataFrame:
        from_order = [c for c in cols if c == "customer_key"]
        derived = {
            "return_key": F.col("order_line_key"),
            "return_date": self._return_date(),
            "return_reason_key": (1 + (F.col("l_partkey") + F.col("l_linenumber")) % 6).cast("int"),
            "return_quantity": self._returned_units(),
            "refund_c": ops.refund(F.col("net_c"), self._returned_units(), F.col("quantity")),
            "refund_completed_flag": ops.refund_completed(self._return_date(), F.lit(self.horizon)),
        }
        derived["fee_c"] = ops.restocking_fee(derived["refund_c"], derived["return_reason_key"])
        first, last = during or (self.calendar_start, self.horizon)
        held = self.held.get("returns")
        if held is not None and set(cols) <= set(held.columns):
            return held.filter(F.col("return_date").between(F.lit(first), F.lit(last))).select(*cols)
        back = F.col("l_returnflag") == "R"
        if {"return_key", "order_line_key"} & set(cols):
            # The columns that the key is made of are narrower than it, and money can be made of them.
            rows = self._derived(self._with_orders(self.raw("lineitem").filter(back), *from_order, "order_date"))
        else:
            rows = self._priced.filter(back).join(self._counted(*from_order, "order_date"), "order_key")
        return (
            rows
            .filter(self._return_date().between(F.lit(first), F.lit(min(last, self.horizon))))
            .select(*[derived[c].alias(c) if c in derived else F.col(c) for c in cols])
        )

    def orders(self, *cols: str, during: Period = None) -> DataFrame:
        money = [c for c in ("gross_c", "discount_c", "net_c") if c in cols]
        if "shipping_c" in cols and "net_c" not in money:
            money.append("net_c")
        # Lines shrink to one row per order before they meet the orders.
        sums = self._priced.groupBy("order_key").agg(
            *[F.sum(c).alias(c) for c in money] or [F.count("*").alias("_lines")]
        )
        # order_key comes with every frame; the rest follows what is asked for.
        attrs = [c for c in ("customer_key", "order_date", "sales_channel_key") if c in cols]
        of_customer = [c for c in ("geography_key", "acquisition_channel_key") if c in cols]
        first = "is_first_order" in cols
        if first and during is not None:
            raise ValueError("a customer's first order is known over all time only")
        if (of_customer or first) and "customer_key" not in attrs:
            attrs.append("customer_key")
        if ("campaign_key" in cols or first) and "order_date" not in attrs:
            attrs.append("order_date")
        held = self._held_orders(during)
        df = self._counted(*attrs, during=during) if held is None else held.select("order_key", *attrs, *money)
        if of_customer:
            # Customers come first, so that orders are left dealt by their own key.
            who = self.customers("customer_key", "home_geography_key", "acquisition_channel_key")
            df = df.join(who.withColumnRenamed("home_geography_key", "geography_key"), "customer_key")
        if held is None:
            df = df.join(sums, "order_key")
        if first:
            df = ops.first_order_flag(df)
        if "campaign_key" in cols:
            days = cal.campaign_day_map(self.campaigns()).select(
                F.col("full_date").alias("order_date"), "campaign_key"
            )
            # One row per calendar day at most.
            df = df.join(F.broadcast(days), "order_date", "left")
        if "shipping_c" in cols:
            df = df.withColumn("shipping_c", ops.shipping(F.col("net_c")))
        return df.select(*cols)

    def snapshot(self) -> DataFrame:
        return customer_monthly_snapshot(
            self.customers("customer_key", "signup_date"),
            self.orders("customer_key", "order_date", "net_c"),
            self.returns("customer_key", "return_date", "refund_c"),
            self.horizon,
        )

    # -- what a job that reads the facts many times stores of them --------------

    def hold_facts(self, orders: bool = False, returns: bool = False, products: bool = False) -> None:
        """Store the keys of lines that no order counts; lines less theirs need not meet the orders each time.

        ``orders``, ``returns`` and ``products`` store orders with their sums, returns and the sums of products too.
        """
        keys = self.raw("lineitem").select(F.col("l_orderkey").alias("order_key")).filter("order_key is not null").distinct()
        jobs = {"strays": lambda: keys.join(self._counted(), "order_key", "left_anti")}
        if orders:
            jobs["orders"] = lambda: self._order_ledger("channel_name")
        if returns:
            cols = ("product_key", "return_date", "return_reason_key", "return_quantity", "refund_c", "fee_c")
            jobs["returns"] = lambda: self.returns(*cols)
        self._hold(jobs)
        if products:
            sums = {"product_totals": self.product_totals}
            self._hold(sums | ({"product_returns": self.product_returns} if returns else {}))

    def _hold(self, jobs: dict[str, Callable[[], DataFrame]]) -> None:
        due = {k: job for k, job in jobs.items() if k not in self.held}
        made = run_together([lambda k=k, job=job: stage(job(), k, lean=True) for k, job in due.items()])
        self.held.update(zip(due, made))

    def _held_orders(self, during: Period) -> DataFrame | None:
        held = self.held.get("orders")
        return held if held is None or during is None else held.filter(F.col("order_date").between(*map(F.lit, during)))

    def product_returns(self, *attributes: str) -> DataFrame:
        held = self.held.get("product_returns")
        if held is None:
            return super().product_returns(*attributes)
        return held.join(self.products("product_key", *attributes), "product_key") if attributes else held

    # -- shorter ways than the general ones ------------------------------------

    def orders_by_customer(self, *by: str, during: Period = None) -> DataFrame:
        """Geography and channel are the customer's, so orders shrink to customers
        before they meet the customer table and a customer with very many orders
        is one row there."""
        of_customer = [c for c in by if c in ("geography_key", "acquisition_channel_key")]
        per = super().orders_by_customer(*[c for c in by if c not in of_customer], during=during)
        if not of_customer:
            return per
        who = self.customers("customer_key", "home_geography_key", "acquisition_channel_key")
        return per.join(
            who.withColumnRenamed("home_geography_key", "geography_key").select("customer_key", *of_customer),
            "customer_key",
        )

    def orders_by_sales_channel(self, *by: str, during: Period = None) -> DataFrame:
        """The name stands in the order, so no list of channels is needed."""
        cols = ["order_date" if c == "year" else c for c in by]
        orders = self._held_orders(during)
        if orders is None:
            sums = self._priced.groupBy("order_key").agg(F.sum("net_c").alias("net_c"))
            orders = self._counted("channel_name", *cols, during=during).join(sums, "order_key")
        if "year" in by:
            orders = orders.withColumn("year", F.year("order_date"))
        return orders.groupBy("channel_name", *by).agg(F.count("*").alias("orders"), F.sum("net_c").alias("net_c"))

    def order_line_totals(self) -> DataFrame:
        """Lines are summed before orders are filtered, so an order with very many
        lines is one row in the join."""
        sums = self._priced.groupBy("order_key").agg(
            F.count("*").alias("lines"), *[F.sum(c).alias(c) for c in ("gross_c", "discount_c", "net_c")]
        )
        return sums.join(self._counted(), "order_key", "left_semi")

    def product_totals(self, *attributes: str) -> DataFrame:
        """Cost is a product attribute here, so lines shrink before the part join."""
        held = self.held.get("product_totals")
        if held is not None:
            return held.join(self.products("product_key", *attributes), "product_key") if attributes else held
        sold = (
            self.lines("product_key", "quantity", "net_c")
            .groupBy("product_key")
            .agg(F.sum("quantity").alias("units"), F.sum("net_c").alias("net_c"))
        )
        return sold.join(self.products("product_key", "unit_cost_c", *attributes), "product_key").select(
            "product_key", "units", "net_c", (F.col("units") * F.col("unit_cost_c")).alias("cost_c"), *attributes
        )

    def order_ledger(self) -> DataFrame:
        held = self.held.get("orders")
        return self._order_ledger() if held is None else held.drop("channel_name")

    def _order_ledger(self, *more: str) -> DataFrame:
        """Sales and refunds of an order in one pass over the lines.

        The return date hangs on the order only, so whether an order's returns
        fall before the horizon is settled after the lines are summed.
        """
        back = F.col("l_returnflag") == "R"
        refund_c = ops.refund(F.col("net_c"), self._returned_units(), F.col("quantity"))
        sums = self._priced.groupBy("order_key").agg(
            F.sum("gross_c").alias("gross_c"),
            F.sum("discount_c").alias("discount_c"),
            F.sum("net_c").alias("net_c"),
            F.sum("quantity").alias("units"),
            F.sum(F.when(back, refund_c).otherwise(0)).alias("refund_c"),
            F.sum(F.when(back, self._returned_units()).otherwise(0)).alias("units_returned"),
        )
        seen = self._return_date() <= F.lit(self.horizon)
        return (
            self._counted("customer_key", "order_date", "sales_channel_key", *more)
            .join(sums, "order_key")
            .withColumn("refund_c", F.when(seen, F.col("refund_c")).otherwise(0))
            .withColumn("units_returned", F.when(seen, F.col("units_returned")).otherwise(0))
        )

    def final_buyers(self) -> DataFrame:
        """No order or return lies after the horizon, so lifetime sums are the last month's."""
        return buyer_totals(self).select(
            "customer_key",
            F.datediff(F.lit(self.horizon), "last_order").alias("recency_days"),
            F.col("orders").alias("cumulative_orders_to_date"),
            (F.col("net_c") - F.col("refund_c")).alias("cumulative_net_c"),
        )

    def final_snapshot(self) -> DataFrame:
        """The last month end without building the months before it."""
        return (
            self.customers("customer_key", "signup_date")
            .filter(F.col("signup_date") <= F.lit(self.horizon))
            .select("customer_key")
            .join(self.final_buyers(), "customer_key", "left")
            .fillna(0, ["cumulative_orders_to_date", "cumulative_net_c"])
            .withColumn("month_end", F.lit(self.horizon))
            .withColumn("is_active_flag", F.coalesce(F.col("recency_days") <= ACTIVE_DAYS, F.lit(False)))
            .withColumn("is_repeat_customer_flag", F.col("cumulative_orders_to_date") >= 2)
        )
