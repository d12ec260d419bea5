"""The public star schema: eight dimensions and four facts."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, types and nullability of the stored tables.
_TABLES: dict[str, str] = {
    "dim_date": (
        "date_key int not null, full_date date not null, year int not null, quarter int not null,"
        " month int not null, month_name string not null, week_of_year int not null,"
        " day_of_week int not null, day_name string not null, is_weekend boolean not null,"
        " holiday_flag boolean not null, fiscal_quarter int not null, fiscal_year int not null,"
        " season string not null, campaign_period_flag boolean not null"
    ),
    "dim_geography": (
        "geography_key int not null, city string not null, state string not null,"
        " region string not null, country string not null, postal_code string"
    ),
    "dim_marketing_channel": (
        "marketing_channel_key int not null, channel_name string not null, channel_category string not null"
    ),
    "dim_sales_channel": (
        "sales_channel_key int not null, channel_name string not null, channel_type string not null"
    ),
    "dim_campaign": (
        "campaign_key int not null, campaign_name string not null, campaign_type string not null,"
        " start_date date not null, end_date date not null, discount_depth string not null,"
        " season string not null, target_audience string not null, is_active_flag boolean not null"
    ),
    "dim_return_reason": (
        "return_reason_key int not null, reason_code string not null,"
        " reason_description string not null, is_controllable boolean not null"
    ),
    "dim_customer": (
        "customer_key bigint not null, customer_id string not null, first_name string not null,"
        " last_name string not null, email string not null, signup_date date not null, birth_year int,"
        " acquisition_channel_key int not null, home_geography_key int not null"
    ),
    "dim_product": (
        "product_key bigint not null, product_id string not null, product_name string not null,"
        " category string not null, subcategory string not null, gender string not null, size string,"
        " color string, collection_season string not null, list_price decimal(10,2) not null,"
        " unit_cost decimal(10,2) not null, is_active boolean not null"
    ),
    "fact_orders": (
        "order_key bigint not null, order_id string not null, customer_key bigint not null,"
        " order_date_key int not null, sales_channel_key int not null, geography_key int not null,"
        " campaign_key int, acquisition_channel_key int not null, gross_revenue decimal(12,2) not null,"
        " discount_amount decimal(12,2) not null, net_revenue decimal(12,2) not null,"
        " shipping_revenue decimal(10,2) not null, is_first_order boolean not null"
    ),
    "fact_order_lines": (
        "order_line_key string not null, order_key bigint not null, customer_key bigint not null,"
        " product_key bigint not null, order_date_key int not null, quantity bigint not null,"
        " unit_price decimal(10,2) not null, gross_line_revenue decimal(12,2) not null,"
        " discount_amount decimal(10,2) not null, net_line_revenue decimal(12,2) not null,"
        " unit_cost decimal(10,2) not null"
    ),
    "fact_returns": (
        "return_key string not null, order_key bigint not null, order_line_key string not null,"
        " customer_key bigint not null, product_key bigint not null, return_date_key int not null,"
        " return_reason_key int not null, return_quantity bigint not null,"
        " return_amount decimal(12,2) not null, restocking_fee decimal(10,2) not null,"
        " refund_completed_flag boolean not null"
    ),
    "fact_customer_monthly_snapshot": (
        "snapshot_key string not null, customer_key bigint not null, snapshot_month_date_key int not null,"
        " customer_age_days int not null, months_since_first_purchase int, recency_days int,"
        " orders_last_30_days bigint not null, orders_last_90_days bigint not null,"
        " cumulative_orders_to_date bigint not null, cumulative_net_revenue_to_date decimal(14,2) not null,"
        " rolling_12mo_net_revenue decimal(14,2) not null, is_active_flag boolean not null,"
        " is_repeat_customer_flag boolean not null, churn_risk_flag boolean not null"
    ),
}

DIMENSIONS = tuple(t for t in _TABLES if t.startswith("dim_"))
FACTS = tuple(t for t in _TABLES if t.startswith("fact_"))
TABLES = DIMENSIONS + FACTS


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(_TABLES[name])
