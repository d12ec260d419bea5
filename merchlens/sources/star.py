"""Access to a retail star schema.

Plans read the star only through the frames below. Each takes the columns it
must return, so a source can skip joins and scans it does not need. Facts give
money as whole cents (``*_c`` columns, BIGINT) and dates as DATE.

    orders     order_key customer_key order_date sales_channel_key geography_key
               campaign_key acquisition_channel_key gross_c discount_c net_c
               shipping_c is_first_order
    lines      order_line_key order_key customer_key product_key order_date
               quantity gross_c discount_c net_c unit_cost_c
    returns    return_key order_key order_line_key customer_key product_key
               return_date return_reason_key return_quantity refund_c fee_c
               refund_completed_flag
    dimensions the stored columns
"""

from __future__ import annotations

import datetime as dt
from abc import ABC, abstractmethod
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.functions.dates import date_key, date_of_key
from merchlens.functions.money import cents_of_decimal, decimal_of
from merchlens.operators.snapshot import customer_monthly_snapshot, first_day_needed
from merchlens.schema import TABLES, table_schema
from merchlens.sources.versions import current

# The partition column of stored facts: year and month of the fact's date, as 199503.
MONTH = "month_key"
# First and last day of a period; None is all time.
Period = tuple[dt.date, dt.date] | None


class Star(ABC):
    """One star, as read by one job. ``held`` keeps tables that job has stored."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.held: dict[str, DataFrame] = {}

    @property
    @abstractmethod
    def horizon(self) -> dt.date:
        """The last day observed: the month end the final snapshot is taken at."""

    @property
    @abstractmethod
    def calendar_start(self) -> dt.date:
        """The first day of the calendar."""

    @abstractmethod
    def orders(self, *cols: str, during: Period = None) -> DataFrame:
        """Orders, or those of a period; a source reads no more of its files than it must."""

    @abstractmethod
    def lines(self, *cols: str, during: Period = None) -> DataFrame:
        """Order lines, or those ordered in a period."""

    def lines_with(self, goods: DataFrame, *cols: str) -> DataFrame:
        """Lines with the columns of ``goods``, in which ``p_key`` is the product; a line whose product is not there stays."""
        return self.lines(*cols).join(goods, F.col("product_key") == F.col("p_key"), "left")

    def line_keys(self) -> list[DataFrame]:
        """The keys of lines: order_line_key, order_key, customer_key, product_key and order_date.

        They may come in several frames of some of the columns each. A row of a frame with ``n`` stands for so many lines.
        """
        return [self.lines("order_line_key", "order_key", "customer_key", "product_key", "order_date")]

    @abstractmethod
    def returns(self, *cols: str, during: Period = None) -> DataFrame:
        """Returns, or those returned in a period."""

    @abstractmethod
    def customers(self, *cols: str) -> DataFrame: ...

    @abstractmethod
    def products(self, *cols: str) -> DataFrame: ...

    @abstractmethod
    def geography(self) -> DataFrame: ...

    @abstractmethod
    def marketing_channels(self) -> DataFrame: ...

    @abstractmethod
    def sales_channels(self) -> DataFrame: ...

    @abstractmethod
    def campaigns(self) -> DataFrame: ...

    @abstractmethod
    def return_reasons(self) -> DataFrame: ...

    @abstractmethod
    def calendar(self) -> DataFrame: ...

    @abstractmethod
    def snapshot(self) -> DataFrame:
        """Customer x month-end rows; money in cents, ``month_end`` as DATE."""

    def snapshot_since(self, since: dt.date, state: DataFrame) -> DataFrame:
        """The snapshot's months from ``since`` on, given the month before; events of the last year are read at most."""
        events = (first_day_needed(since), self.horizon)
        return customer_monthly_snapshot(
            self.customers("customer_key", "signup_date"),
            self.orders("customer_key", "order_date", "net_c", during=events),
            self.returns("customer_key", "return_date", "refund_c", during=events),
            self.horizon,
            since,
            state,
        )

    # -- pre-aggregates that plans share; sources may have a shorter way -------

    def hold_facts(self, orders: bool = False, returns: bool = False, products: bool = False) -> None:
        """Get ready for a job that reads lines, and maybe orders, returns or product totals, many times."""

    def final_snapshot(self) -> DataFrame:
        """The snapshot rows of the last month end."""
        return self.snapshot().filter(F.col("month_end") == F.lit(self.horizon))

    def final_buyers(self) -> DataFrame:
        """Final snapshot rows of customers with an order.

        customer_key recency_days cumulative_orders_to_date cumulative_net_c
        """
        return (
            self.final_snapshot()
            .filter("cumulative_orders_to_date > 0")
            .select("customer_key", "recency_days", "cumulative_orders_to_date", "cumulative_net_c")
        )

    def product_totals(self, *attributes: str) -> DataFrame:
        """product_key, units, net_c, cost_c over all sold lines, with product attributes."""
        sold = (
            self.lines("product_key", "quantity", "net_c", "unit_cost_c")
            .groupBy("product_key")
            .agg(
                F.sum("quantity").alias("units"),
                F.sum("net_c").alias("net_c"),
                F.sum(F.col("quantity") * F.col("unit_cost_c")).alias("cost_c"),
            )
        )
        return sold.join(self.products("product_key", *attributes), "product_key") if attributes else sold

    def product_returns(self, *attributes: str) -> DataFrame:
        """product_key, units_returned, refund_c over all returns, with product attributes."""
        back = (
            self.returns("product_key", "return_quantity", "refund_c")
            .groupBy("product_key")
            .agg(F.sum("return_quantity").alias("units_returned"), F.sum("refund_c").alias("refund_c"))
        )
        return back.join(self.products("product_key", *attributes), "product_key") if attributes else back

    def orders_by_customer(self, *by: str, during: Period = None) -> DataFrame:
        """customer_key, ``by``, orders, net_c: orders summed per customer.

        ``by`` names order columns, or ``year`` for the year of the order date.
        """
        cols = ["order_date" if c == "year" else c for c in by]
        orders = self.orders("customer_key", *cols, "net_c", during=during)
        if "year" in by:
            orders = orders.withColumn("year", F.year("order_date"))
        return orders.groupBy("customer_key", *by).agg(F.count("*").alias("orders"), F.sum("net_c").alias("net_c"))

    def orders_by_sales_channel(self, *by: str, during: Period = None) -> DataFrame:
        """channel_name, ``by``, orders, net_c: orders summed per sales channel."""
        cols = ["order_date" if c == "year" else c for c in by]
        orders = self.orders("sales_channel_key", *cols, "net_c", during=during)
        if "year" in by:
            orders = orders.withColumn("year", F.year("order_date"))
        per = orders.groupBy("sales_channel_key", *by).agg(F.count("*").alias("orders"), F.sum("net_c").alias("net_c"))
        names = self.sales_channels().select("sales_channel_key", "channel_name")
        return (
            per.join(names, "sales_channel_key")
            .groupBy("channel_name", *by)
            .agg(F.sum("orders").alias("orders"), F.sum("net_c").alias("net_c"))
        )

    def order_line_totals(self) -> DataFrame:
        """order_key, lines, gross_c, discount_c, net_c: lines summed per order."""
        return (
            self.lines("order_key", "gross_c", "discount_c", "net_c")
            .groupBy("order_key")
            .agg(F.count("*").alias("lines"), *[F.sum(c).alias(c) for c in ("gross_c", "discount_c", "net_c")])
        )

    def order_ledger(self) -> DataFrame:
        """One row per order with its sales and the refunds it drew.

        order_key customer_key order_date sales_channel_key gross_c discount_c
        net_c units refund_c units_returned
        """
        sold = self.lines("order_key", "quantity").groupBy("order_key").agg(F.sum("quantity").alias("units"))
        back = (
            self.returns("order_key", "refund_c", "return_quantity")
            .groupBy("order_key")
            .agg(F.sum("refund_c").alias("refund_c"), F.sum("return_quantity").alias("units_returned"))
        )
        return (
            self.orders(
                "order_key", "customer_key", "order_date", "sales_channel_key", "gross_c", "discount_c", "net_c"
            )
            .join(sold, "order_key", "left")
            .join(back, "order_key", "left")
            .fillna(0, ["units", "refund_c", "units_returned"])
        )


class StoredStar(Star):
    """A star kept as twelve tables below one folder, each as published or as a plain folder."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        super().__init__(spark)
        self.root, self.fmt = root.rstrip("/"), fmt
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A table; all reads of one star see the version that the first one saw."""
        if name not in self._read:
            self._read[name] = _stored_table(self.spark, self.root, name, self.fmt)
        return self._read[name]

    def _within(self, df: DataFrame, date_key: str, during: Period) -> DataFrame:
        """Rows of a period, by the stored keys alone: whole months by partition, days by the file's own bounds."""
        if during is None:
            return df
        first, last = ((d.year * 100 + d.month) * 100 + d.day for d in during)
        if MONTH in df.columns:
            df = df.filter(F.col(MONTH).between(first // 100, last // 100))
        return df.filter(F.col(date_key).between(first, last))

    @cached_property
    def _bounds(self) -> tuple[dt.date, dt.date]:
        return tuple(self.table("dim_date").agg(F.min("full_date"), F.max("full_date")).first())

    @property
    def calendar_start(self) -> dt.date:
        return self._bounds[0]

    @property
    def horizon(self) -> dt.date:
        return self._bounds[1]

    def orders(self, *cols: str, during: Period = None) -> DataFrame:
        o = self._within(self.table("fact_orders"), "order_date_key", during)
        return o.select(
            "*",
            date_of_key(o.order_date_key).alias("order_date"),
            cents_of_decimal(o.gross_revenue).alias("gross_c"),
            cents_of_decimal(o.discount_amount).alias("discount_c"),
            cents_of_decimal(o.net_revenue).alias("net_c"),
            cents_of_decimal(o.shipping_revenue).alias("shipping_c"),
        ).select(*cols)

    def lines(self, *cols: str, during: Period = None) -> DataFrame:
        ln = self._within(self.table("fact_order_lines"), "order_date_key", during)
        return ln.select(
            "*",
            date_of_key(ln.order_date_key).alias("order_date"),
            cents_of_decimal(ln.gross_line_revenue).alias("gross_c"),
            cents_of_decimal(ln.discount_amount).alias("discount_c"),
            cents_of_decimal(ln.net_line_revenue).alias("net_c"),
            cents_of_decimal(ln.unit_cost).alias("unit_cost_c"),
        ).select(*cols)

    def returns(self, *cols: str, during: Period = None) -> DataFrame:
        r = self._within(self.table("fact_returns"), "return_date_key", during)
        return r.select(
            "*",
            date_of_key(r.return_date_key).alias("return_date"),
            cents_of_decimal(r.return_amount).alias("refund_c"),
            cents_of_decimal(r.restocking_fee).alias("fee_c"),
        ).select(*cols)

    def customers(self, *cols: str) -> DataFrame:
        return self.table("dim_customer").select(*cols)

    def products(self, *cols: str) -> DataFrame:
        return self.table("dim_product").select(*cols)

    def geography(self) -> DataFrame:
        return self.table("dim_geography")

    def marketing_channels(self) -> DataFrame:
        return self.table("dim_marketing_channel")

    def sales_channels(self) -> DataFrame:
        return self.table("dim_sales_channel")

    def campaigns(self) -> DataFrame:
        return self.table("dim_campaign")

    def return_reasons(self) -> DataFrame:
        return self.table("dim_return_reason")

    def calendar(self) -> DataFrame:
        return self.table("dim_date")

    def snapshot(self) -> DataFrame:
        return self._months(self.table("fact_customer_monthly_snapshot"))

    def final_snapshot(self) -> DataFrame:
        """The last month end, read from its partition alone."""
        return self.snapshot_of(self.horizon)

    def snapshot_of(self, month_end: dt.date) -> DataFrame:
        """The rows of one month end."""
        s = self.table("fact_customer_monthly_snapshot")
        return self._months(self._within(s, "snapshot_month_date_key", (month_end, month_end)))

    @staticmethod
    def _months(s: DataFrame) -> DataFrame:
        return s.select(
            "customer_key",
            date_of_key(s.snapshot_month_date_key).alias("month_end"),
            "customer_age_days",
            "months_since_first_purchase",
            "recency_days",
            "orders_last_30_days",
            "orders_last_90_days",
            "cumulative_orders_to_date",
            cents_of_decimal(s.cumulative_net_revenue_to_date).alias("cumulative_net_c"),
            cents_of_decimal(s.rolling_12mo_net_revenue).alias("rolling_12mo_c"),
            "is_active_flag",
            "is_repeat_customer_flag",
            "churn_risk_flag",
        )


def table_path(root: str, name: str, fmt: str = "parquet") -> str:
    return f"{root.rstrip('/')}/{name}" + (".csv" if fmt == "csv" else "")


def _stored_table(spark: SparkSession, root: str, name: str, fmt: str) -> DataFrame:
    """The table's current version (with its partition column), or the plain folder where none was published."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = table_path(root, name, fmt)
    version = current(spark, path)
    schema = table_schema(name)
    if version and version.partition_by:
        schema = T.StructType([*schema.fields, T.StructField(version.partition_by, T.IntegerType())])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST")
    reader = reader.format(fmt)
    if version is None:
        df = reader.load(path)
        if not df.take(1):
            raise ValueError(f"table {name} at {path} is empty")
        return df
    layers = [_layer(reader.load(x.folder), version.partition_by, x.first, x.last) for x in version.read_from()]
    return reduce(DataFrame.unionByName, layers)


def _layer(df: DataFrame, column: str | None, first: int | None, last: int | None) -> DataFrame:
    for edge, inside in ((first, lambda: F.col(column) >= first), (last, lambda: F.col(column) <= last)):
        if edge is not None:
            df = df.filter(inside())
    return df


def read_star_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Read one table with its declared schema and fail if it holds no row.

    A published table is read at its current version, which is never empty; a plain folder is looked into.
    CSV files carry a header; an empty field is NULL, the word ``None`` is text.
    """
    return _stored_table(spark, root, name, fmt).select(*table_schema(name).names)


def stored_form(star: Star, name: str) -> DataFrame:
    """A table of ``star`` in the columns and types it is stored with."""
    if name == "dim_date":
        df = star.calendar()
    elif name == "dim_geography":
        df = star.geography()
    elif name == "dim_marketing_channel":
        df = star.marketing_channels()
    elif name == "dim_sales_channel":
        df = star.sales_channels()
    elif name == "dim_campaign":
        df = star.campaigns()
    elif name == "dim_return_reason":
        df = star.return_reasons()
    elif name == "dim_customer":
        df = star.customers(*table_schema(name).names)
    elif name == "dim_product":
        df = star.products(*table_schema(name).names)
    elif name == "fact_orders":
        df = star.orders(
            "order_key", "customer_key", "order_date", "sales_channel_key", "geography_key", "campaign_key",
            "acquisition_channel_key", "gross_c", "discount_c", "net_c", "shipping_c", "is_first_order",
        ).select(
            "*",
            F.format_string("ORD-%06d", F.col("order_key")).alias("order_id"),
            date_key(F.col("order_date")).alias("order_date_key"),
            decimal_of(F.col("gross_c")).alias("gross_revenue"),
            decimal_of(F.col("discount_c")).alias("discount_amount"),
            decimal_of(F.col("net_c")).alias("net_revenue"),
            decimal_of(F.col("shipping_c"), 10).alias("shipping_revenue"),
        )
    elif name == "fact_order_lines":
        df = star.lines(
            "order_line_key", "order_key", "customer_key", "product_key", "order_date", "quantity",
            "gross_c", "discount_c", "net_c", "unit_cost_c",
        ).select(
            "*",
            date_key(F.col("order_date")).alias("order_date_key"),
            (decimal_of(F.col("gross_c")) / F.col("quantity")).alias("unit_price"),
            decimal_of(F.col("gross_c")).alias("gross_line_revenue"),
            decimal_of(F.col("discount_c"), 10).alias("discount_amount"),
            decimal_of(F.col("net_c")).alias("net_line_revenue"),
            decimal_of(F.col("unit_cost_c"), 10).alias("unit_cost"),
        )
    elif name == "fact_returns":
        df = star.returns(
            "return_key", "order_key", "order_line_key", "customer_key", "product_key", "return_date",
            "return_reason_key", "return_quantity", "refund_c", "fee_c", "refund_completed_flag",
        ).select(
            "*",
            date_key(F.col("return_date")).alias("return_date_key"),
            decimal_of(F.col("refund_c")).alias("return_amount"),
            decimal_of(F.col("fee_c"), 10).alias("restocking_fee"),
        )
    elif name == "fact_customer_monthly_snapshot":
        return stored_snapshot(star.snapshot())
    else:
        raise ValueError(f"unknown table {name!r}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(name).fields])


def stored_snapshot(rows: DataFrame) -> DataFrame:
    """Rows of a snapshot in the columns and types they are stored with."""
    df = rows.select(
        "*",
        F.concat_ws("-", "customer_key", date_key(F.col("month_end"))).alias("snapshot_key"),
        date_key(F.col("month_end")).alias("snapshot_month_date_key"),
        decimal_of(F.col("cumulative_net_c"), 14).alias("cumulative_net_revenue_to_date"),
        decimal_of(F.col("rolling_12mo_c"), 14).alias("rolling_12mo_net_revenue"),
    )
    fields = table_schema("fact_customer_monthly_snapshot").fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
