"""Rules of single tables, and quality operators, on a stored star and on a derived one."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from merchlens import RetailStar, StoredStar
from merchlens.operators import quality as q
from merchlens.params import RETAIL_PARAMS
from merchlens.plans import quality, star_rules
from merchlens.session import scratch_path
from merchlens.sources.publish import publish_star


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    root = scratch_path(spark, "ruled")
    publish_star(RetailStar(spark, sf_dir), root)
    return StoredStar(spark, root)


def _rules(star, suite):
    return {r.rule: r for r in star_rules.SUITES[suite](star, RETAIL_PARAMS).collect()}


@pytest.mark.parametrize("suite", star_rules.SUITES)
def test_both_kinds_of_star_give_the_same_rules(star, stored, suite):
    found = _rules(stored, suite)
    assert found == _rules(star, suite)
    assert {r.status for r in found.values()} <= {"PASS", "FINDING"} and "not made" not in {r.evidence for r in found.values()}


class _Broken(StoredStar):
    def __init__(self, spark, root, faults):
        super().__init__(spark, root)
        self.faults = faults

    def table(self, name):
        df = super().table(name)
        for change in self.faults.get(name, ()):
            df = change(df)
        return df


def _set(column, key, value, to):
    return lambda df: df.withColumn(column, F.when(F.col(key) == value, to).otherwise(F.col(column)).cast(df.schema[column].dataType))


def test_planted_faults_are_found_and_named(spark, stored):
    orders = stored.table("fact_orders").orderBy("order_key").limit(6).collect()
    lines = stored.table("fact_order_lines").orderBy("order_line_key").limit(3).collect()
    # Reason 4 is the changed mind, which alone carries a fee.
    backs = stored.table("fact_returns").filter("return_reason_key <> 4").orderBy("return_key").limit(5).collect()
    snaps = stored.table("fact_customer_monthly_snapshot").filter("snapshot_month_date_key = 19980331").orderBy("customer_key").limit(9).collect()
    second = next(r for r in orders if not r.is_first_order)
    first = next(r for r in orders if r.is_first_order)
    faults, wanted = {}, []

    def plant(suite, rule, table, column, key, row, to, named=None):
        faults.setdefault(table, []).append(_set(column, key, row[key], to))
        wanted.append((suite, rule, str(named if named is not None else row[key])))

    o, ln, r, s = "dq_star_orders", "dq_star_lines", "dq_star_returns", "dq_star_snapshot"
    plant(o, "net is gross less discount", "fact_orders", "net_revenue", "order_key", orders[0], F.col("net_revenue") + 1)
    plant(o, "shipping follows the threshold", "fact_orders", "shipping_revenue", "order_key", orders[1], F.lit(1.23))
    plant(o, "money is not negative", "fact_orders", "shipping_revenue", "order_key", orders[2], F.lit(-1))
    plant(o, "a customer has one first order", "fact_orders", "is_first_order", "order_key", second, F.lit(True), second.customer_key)
    plant(o, "the first order is on the first day", "fact_orders", "order_date_key", "order_key", first, F.lit(20010701), first.customer_key)
    plant(ln, "quantity is positive", "fact_order_lines", "quantity", "order_line_key", lines[0], F.lit(0))
    plant(ln, "net is gross less discount", "fact_order_lines", "net_line_revenue", "order_line_key", lines[1], F.col("net_line_revenue") + 1)
    plant(ln, "discount does not exceed gross", "fact_order_lines", "discount_amount", "order_line_key", lines[2], F.lit(-3))
    plant(r, "returned five to 21 days after the order", "fact_returns", "return_date_key", "return_key", backs[0], F.lit(20010801))
    plant(r, "no more units than sold", "fact_returns", "return_quantity", "return_key", backs[1], F.lit(99))
    plant(r, "refund within the line's net", "fact_returns", "return_amount", "return_key", backs[2], F.col("return_amount") + 999_999)
    plant(r, "a fee for changed minds only", "fact_returns", "restocking_fee", "return_key", backs[3], F.lit(5))
    plant(r, "completed after five days", "fact_returns", "refund_completed_flag", "return_key", backs[4], ~F.col("refund_completed_flag"))
    for rule, column, row, to in [
        ("age is not negative", "customer_age_days", snaps[0], F.lit(-5)),
        ("recency is known from the first order on", "recency_days", snaps[1], F.when(F.col("recency_days").isNull(), 5)),
        ("30 days lie in 90 days lie in all", "orders_last_30_days", snaps[2], F.lit(50)),
        ("active within 90 days", "is_active_flag", snaps[3], ~F.col("is_active_flag")),
        ("at risk from 61 to 90 days", "churn_risk_flag", snaps[4], ~F.col("churn_risk_flag")),
        ("repeat from two orders", "is_repeat_customer_flag", snaps[5], ~F.col("is_repeat_customer_flag")),
        ("age grows", "customer_age_days", snaps[6], F.lit(0)),
        ("orders never fall", "cumulative_orders_to_date", snaps[7], F.lit(0)),
    ]:
        plant(s, rule, "fact_customer_monthly_snapshot", column, "snapshot_key", row, to, f"{row.customer_key} 1998-")
    faults["fact_customer_monthly_snapshot"].append(lambda df: df.filter(F.col("snapshot_key") != snaps[8].snapshot_key))
    wanted.append((s, "months follow one another", f"{snaps[8].customer_key} 1998-04-30"))
    d = "dq_star_dimensions"
    plant(d, "depth follows the campaign's name", "dim_campaign", "discount_depth", "campaign_key", {"campaign_key": 3}, F.lit("Deep"))
    plant(d, "campaigns end after they start", "dim_campaign", "end_date", "campaign_key", {"campaign_key": 4}, F.lit(dt.date(1990, 1, 1)))
    faults["dim_campaign"].append(lambda df: df.filter("campaign_key <> 9"))
    wanted.append((d, "campaigns run every year", "Summer Sale"))
    plant(d, "emails look like emails", "dim_customer", "email", "customer_key", {"customer_key": 2}, F.lit("nobody"))
    plant(d, "customer ids are unique", "dim_customer", "customer_id", "customer_key", {"customer_key": 3}, F.lit("CUST-000001"), "CUST-000001")
    plant(d, "costs do not exceed prices", "dim_product", "unit_cost", "product_key", {"product_key": 5}, F.lit(99_999))
    plant(d, "prices and costs are positive", "dim_product", "list_price", "product_key", {"product_key": 6}, F.lit(0))

    found = {suite: _rules(_Broken(spark, stored.root, faults), suite) for suite in star_rules.SUITES}
    for suite, rule, key in wanted:
        row = found[suite][rule]
        assert row.status == "FAIL" and row.violations > 0 and key in row.evidence, (suite, row, key)


# Two operators compare a star with itself or with its calendar, and have no table of their own.
@pytest.mark.parametrize("name", quality.OPERATORS)
def test_every_operator_runs_on_a_stored_star(stored, name):
    rows = quality.OPERATORS[name](stored, RETAIL_PARAMS).collect()
    assert rows
    bad = [r for r in rows if r.asDict().get("status") == "FAIL"]
    # What the data says of the business, and the day shares of a calendar that ends in mid-year, may fail.
    assert not bad or name in ("dq_narrative", "dq_analytics_readiness", "dq_distribution"), bad


def test_stored_keys_and_relations_hold(stored):
    assert sum(r.orphans for r in quality.dq_fk_orphans(stored, RETAIL_PARAMS).collect()) == 0
    assert {r.status for r in quality.dq_pk_unique(stored, RETAIL_PARAMS).collect()} == {"PASS"}
    assert len(quality.dq_fk_orphans(stored, RETAIL_PARAMS).collect()) == 20


def test_the_longest_prefix_decides(spark):
    rules = spark.createDataFrame([("Hat", ["S"]), ("Hat wool", ["L", "M"]), ("H", ["X"])], "prefix string, allowed array<string>")
    rows = [("Hat wool grey", "L"), ("Hat wool", "S"), ("Hat", "S"), ("Hats", None), ("Hut", "X"), ("Shoe", "S"), (None, "S"), ("", "S"), ("Hat wool", "S")]
    df = spark.createDataFrame(rows, "name string, size string")
    found = {r.prefix: (r.rows, r.violations, r.status) for r in q.prefix_domain(df, "name", "size", rules, "sizes").collect()}
    assert found == {"Hat wool": (3, 2, "FAIL"), "Hat": (2, 1, "FAIL"), "H": (1, 0, "PASS"), None: (3, 0, "PASS")}
    none = rules.limit(0)
    assert [tuple(r)[1:4] for r in q.prefix_domain(df, "name", "size", none, "sizes").collect()] == [(None, 9, 0)]
