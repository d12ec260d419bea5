"""What must hold of the raw tables, and of the twelve tables of a stored star, as data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchlens.functions.money import cents
from merchlens.plans.star_rules import CAMPAIGN_DEPTHS
from merchlens.schema import TABLES, table_schema


@dataclass(frozen=True)
class Specs:
    schema: Mapping[str, str]
    minimum_rows: Mapping[str, int]
    # child, foreign key, parent, key
    relations: Sequence[tuple[str, str, str, str]]
    keys: Sequence[tuple[str, str]]
    grains: Sequence[tuple[str, tuple[str, ...]]]
    # Columns that are never NULL; all of a table's where none are named.
    not_null: Mapping[str, Sequence[str]]
    domains: Mapping[tuple[str, str], Sequence[str]]
    patterns: Mapping[tuple[str, str], str]
    # (table, name, value): the values that each beginning of the name allows
    prefixes: Mapping[tuple[str, str, str], Mapping[str, list[str]]]
    distributions: Mapping[tuple[str, str], tuple[Mapping[str, float], float]]
    coverage: Sequence[tuple[str, str, str, str]]
    dates: Sequence[tuple[str, str]]
    dense: Sequence[tuple[str, str]]
    first_key: int
    row_rules: Callable[[], Mapping[str, Mapping[str, Column]]]
    # child, parent, the child's key, the parent's key, rules
    cross_rules: Callable[[], Sequence[tuple[str, str, str, str, Mapping[str, Column]]]]


# What the raw tables declare.
_RAW_SCHEMA = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
}
_MINIMUM_ROWS = {"region": 5, "nation": 25, "customer": 100, "part": 100, "orders": 1000, "lineitem": 1000}
_RELATIONS = [
    # child, foreign key, parent, key
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("events", "user_id", "customer", "c_custkey"),
]
_KEYS = [("customer", "c_custkey"), ("orders", "o_orderkey"), ("part", "p_partkey"), ("supplier", "s_suppkey"),
        ("events", "event_id"), ("lineitem", "l_orderkey")]
_GRAINS = [
    ("lineitem", ("l_orderkey", "l_linenumber")),
    ("lineitem", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")),
    ("orders", ("o_custkey", "o_orderdate")),
]
_DOMAINS = {
    ("orders", "o_orderstatus"): ("F", "O", "P"),
    ("orders", "o_orderpriority"): ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    ("customer", "c_mktsegment"): ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    ("lineitem", "l_returnflag"): ("A", "R"),
    ("part", "p_type"): ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "TINY"),
}
_PATTERNS = {
    ("customer", "c_name"): "^Customer#[0-9]{9}$",
    ("part", "p_brand"): "^Brand#[0-9]{2}$",
    ("orders", "o_orderpriority"): "^[1-5]-[A-Z]+$",
}
_DISTRIBUTIONS = {
    ("orders", "o_orderpriority"): ({p: 20.0 for p in _DOMAINS[("orders", "o_orderpriority")]}, 5.0),
    ("customer", "c_mktsegment"): ({s: 20.0 for s in _DOMAINS[("customer", "c_mktsegment")]}, 0.5),
    ("lineitem", "l_returnflag"): ({"A": 50.0, "R": 33.0}, 5.0),
}
_COVERAGE = [
    ("customer", "c_custkey", "orders", "o_custkey"),
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("part", "p_partkey", "lineitem", "l_partkey"),
    ("supplier", "s_suppkey", "lineitem", "l_suppkey"),
    ("nation", "n_nationkey", "customer", "c_nationkey"),
]


def _raw_row_rules() -> dict[str, dict[str, Column]]:
    lines = {
        "positive_quantity": F.col("l_quantity") > 0,
        "whole_quantity": F.col("l_quantity") == F.floor("l_quantity"),
        "price_not_negative": F.col("l_extendedprice") >= 0,
        "discount_below_ten_percent": F.col("l_discount") < 0.1,
        "line_number_in_range": F.col("l_linenumber").between(1, 7),
        "returned_means_finished": (F.col("l_returnflag") != "R") | (F.col("l_linestatus") == "F"),
    }
    orders = {"positive_total": F.col("o_totalprice") > 0, "date_present": F.col("o_orderdate").isNotNull()}
    return {"lineitem": lines, "orders": orders}


def _raw_cross_rules() -> list[tuple[str, str, str, str, dict[str, Column]]]:
    price = cents(F.col("l_extendedprice"))
    catalog = F.col("l_quantity").cast("bigint") * cents(F.col("p_retailprice"))
    of_order = {
        "ship_not_before_order": F.col("l_shipdate") >= F.col("o_orderdate"),
        "line_within_order_total": F.col("l_extendedprice") <= F.col("o_totalprice"),
    }
    return [
        ("lineitem", "orders", "l_orderkey", "o_orderkey", of_order),
        ("lineitem", "part", "l_partkey", "p_partkey", {"price_not_below_catalog": price >= catalog}),
    ]


RAW = Specs(
    schema=_RAW_SCHEMA, minimum_rows=_MINIMUM_ROWS, relations=_RELATIONS, keys=_KEYS, grains=_GRAINS,
    not_null={"orders": (), "lineitem": (), "customer": ()}, domains=_DOMAINS, patterns=_PATTERNS,
    prefixes={
        ("part", "p_brand", "p_type"): {"Brand#": sorted(_DOMAINS[("part", "p_type")]), "Brand#1": ["ECONOMY", "LARGE", "PROMO"], "Brand#12": ["SMALL", "TINY"]},
        ("orders", "o_orderpriority", "o_orderstatus"): {"1-": ["F", "O"], "2-": ["F", "O", "P"], "4-NOT": ["O"]},
    },
    distributions=_DISTRIBUTIONS, coverage=_COVERAGE,
    dates=[("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")],
    dense=_KEYS, first_key=0, row_rules=_raw_row_rules, cross_rules=_raw_cross_rules,
)


def _stored_row_rules() -> dict[str, dict[str, Column]]:
    return {
        "fact_orders": {
            "money_not_negative": F.least("gross_revenue", "discount_amount", "net_revenue", "shipping_revenue") >= 0,
            "net_is_gross_less_discount": F.abs(F.col("net_revenue") - (F.col("gross_revenue") - F.col("discount_amount"))) <= 0.01,
        },
        "fact_order_lines": {
            "positive_quantity": F.col("quantity") > 0,
            "money_not_negative": F.least("unit_price", "gross_line_revenue", "discount_amount", "net_line_revenue", "unit_cost") >= 0,
        },
        "fact_returns": {"positive_quantity": F.col("return_quantity") > 0, "money_not_negative": F.least("return_amount", "restocking_fee") >= 0},
        "fact_customer_monthly_snapshot": {
            "windows_nested": (F.col("orders_last_30_days") <= F.col("orders_last_90_days"))
            & (F.col("orders_last_90_days") <= F.col("cumulative_orders_to_date")),
        },
        "dim_campaign": {"ends_after_it_starts": F.col("end_date") >= F.col("start_date")},
        "dim_product": {"cost_within_price": F.col("unit_cost") <= F.col("list_price")},
    }


def _stored_cross_rules() -> list[tuple[str, str, str, str, dict[str, Column]]]:
    return [
        ("fact_returns", "fact_orders", "order_key", "order_key", {"return_not_before_order": F.col("return_date_key") >= F.col("order_date_key")}),
        ("fact_returns", "fact_order_lines", "order_line_key", "order_line_key", {"no_more_than_sold": F.col("return_quantity") <= F.col("quantity")}),
        ("fact_orders", "dim_customer", "customer_key", "customer_key", {"channel_is_the_customers": F.col("geography_key") == F.col("home_geography_key")}),
    ]


_STORED_KEYS = [
    ("dim_date", "date_key"), ("dim_geography", "geography_key"), ("dim_marketing_channel", "marketing_channel_key"),
    ("dim_sales_channel", "sales_channel_key"), ("dim_campaign", "campaign_key"), ("dim_return_reason", "return_reason_key"),
    ("dim_customer", "customer_key"), ("dim_product", "product_key"), ("fact_orders", "order_key"),
    ("fact_order_lines", "order_line_key"), ("fact_returns", "return_key"), ("fact_customer_monthly_snapshot", "snapshot_key"),
]
_STORED_RELATIONS = [
    ("dim_customer", "acquisition_channel_key", "dim_marketing_channel", "marketing_channel_key"),
    ("dim_customer", "home_geography_key", "dim_geography", "geography_key"),
    ("fact_orders", "customer_key", "dim_customer", "customer_key"),
    ("fact_orders", "order_date_key", "dim_date", "date_key"),
    ("fact_orders", "sales_channel_key", "dim_sales_channel", "sales_channel_key"),
    ("fact_orders", "geography_key", "dim_geography", "geography_key"),
    ("fact_orders", "campaign_key", "dim_campaign", "campaign_key"),
    ("fact_orders", "acquisition_channel_key", "dim_marketing_channel", "marketing_channel_key"),
    ("fact_order_lines", "order_key", "fact_orders", "order_key"),
    ("fact_order_lines", "customer_key", "dim_customer", "customer_key"),
    ("fact_order_lines", "product_key", "dim_product", "product_key"),
    ("fact_order_lines", "order_date_key", "dim_date", "date_key"),
    ("fact_returns", "order_key", "fact_orders", "order_key"),
    ("fact_returns", "order_line_key", "fact_order_lines", "order_line_key"),
    ("fact_returns", "customer_key", "dim_customer", "customer_key"),
    ("fact_returns", "product_key", "dim_product", "product_key"),
    ("fact_returns", "return_date_key", "dim_date", "date_key"),
    ("fact_returns", "return_reason_key", "dim_return_reason", "return_reason_key"),
    ("fact_customer_monthly_snapshot", "customer_key", "dim_customer", "customer_key"),
    ("fact_customer_monthly_snapshot", "snapshot_month_date_key", "dim_date", "date_key"),
]


@cache
def stored() -> Specs:
    """The stored star's own; types are read from its schema, which needs a session."""
    return Specs(
        schema={t: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(t).fields) for t in TABLES},
        minimum_rows={t: 1 for t in TABLES},
        relations=_STORED_RELATIONS, keys=_STORED_KEYS,
        grains=[("fact_customer_monthly_snapshot", ("customer_key", "snapshot_month_date_key")), ("fact_returns", ("order_line_key",))],
        not_null={t: [f.name for f in table_schema(t).fields if not f.nullable] for t in TABLES},
        domains={("dim_date", "season"): ("Winter", "Spring", "Summer", "Fall"), ("dim_campaign", "discount_depth"): ("None", "Light", "Moderate", "Deep", "Deepest")},
        patterns={("fact_orders", "order_id"): "^ORD-[0-9]{6,}$", ("dim_customer", "customer_id"): "^CUST-[0-9]{6,}$"},
        prefixes={("dim_campaign", "campaign_name", "discount_depth"): dict(CAMPAIGN_DEPTHS)},
        distributions={("dim_date", "is_weekend"): ({"true": 28.6, "false": 71.4}, 0.5)},
        coverage=[
            ("dim_customer", "customer_key", "fact_orders", "customer_key"), ("dim_product", "product_key", "fact_order_lines", "product_key"),
            ("dim_campaign", "campaign_key", "fact_orders", "campaign_key"), ("dim_sales_channel", "sales_channel_key", "fact_orders", "sales_channel_key"),
            ("dim_return_reason", "return_reason_key", "fact_returns", "return_reason_key"),
            ("dim_geography", "geography_key", "dim_customer", "home_geography_key"),
        ],
        dates=[("dim_date", "full_date"), ("dim_customer", "signup_date")],
        dense=[("dim_campaign", "campaign_key"), ("dim_return_reason", "return_reason_key")],
        first_key=1, row_rules=_stored_row_rules, cross_rules=_stored_cross_rules,
    )
