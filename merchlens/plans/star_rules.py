"""Rules of single tables of a star: what must hold inside each fact and dimension.

Each suite is one pass over its table (``operators.checks``) and, where a rule is
about a customer's rows together, one more over what that pass hands up. They
read a star through its own frames, so they run on a stored star and on one
derived from order tables alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.dates import month_index
from merchlens.functions.money import half_up_percent
from merchlens.operators import checks as ck
from merchlens.operators import orders as ops
from merchlens.operators import quality as q
from merchlens.operators.checks import Grain, RolledUp, Rule
from merchlens.params import Params
from merchlens.session import stage
from merchlens.sources.star import Star

# A return follows its order after so many days.
RETURN_DAYS = (5, 21)
# Days of recency up to which a customer is active, and from which one is at risk.
ACTIVE_DAYS, RISK_DAYS = 90, 60
# The discount depth that goes with a campaign's name.
CAMPAIGN_DEPTHS = [
    ("Spring Collection Launch", ["None"]),
    ("Summer Sale", ["Moderate"]),
    ("Back-to-School", ["Moderate"]),
    ("Black Friday", ["Deep"]),
    ("Cyber Monday", ["Deep"]),
    ("Holiday Collection", ["Light"]),
    ("January Clearance", ["Deepest"]),
]


@dataclass(frozen=True)
class Told:
    """A rule's name, and what a violation means."""

    rule: str
    on_violation: str = q.FAIL


def _suite(violations: DataFrame, rules: list[Told]) -> DataFrame:
    """rule, violations, evidence, status for the named rules; one that nothing looked at fails."""
    # Written once: the counts and the evidence both read them.
    found = stage(violations, "violations")
    spark = found.sparkSession
    named = spark.createDataFrame([(r.rule, "1", "BLOCKING", r.rule, r.on_violation) for r in rules],
                                  "check_id string, tier string, severity string, name string, on_violation string")
    none = spark.createDataFrame([], "check string, evidence string, verdict string")
    return ck.judged(named, found, none).select(F.col("check_id").alias("rule"), "violations", "evidence", "status")


def _off(c: Column, by: int) -> Column:
    return F.abs(c) > by


ORDER_RULES = [
    Told("net is gross less discount"), Told("no discount without a campaign", q.FINDING), Told("money is not negative"),
    Told("shipping follows the threshold"), Told("customer and date are present"), Told("a customer has one first order"),
    Told("the first order is on the first day"),
]


def dq_star_orders(star: Star, params: Params) -> DataFrame:
    rows = star.orders(
        "order_key", "customer_key", "order_date", "campaign_key", "gross_c", "discount_c", "net_c", "shipping_c", "is_first_order"
    )
    key = F.col("order_key")
    first = F.col("is_first_order")
    orders = RolledUp(
        rows,
        [
            Rule("net is gross less discount", _off(F.col("net_c") - (F.col("gross_c") - F.col("discount_c")), 1), key),
            Rule("no discount without a campaign", F.col("campaign_key").isNull() & (F.col("discount_c") != 0), key),
            Rule("money is not negative", F.least("gross_c", "discount_c", "net_c", "shipping_c") < 0, key),
            Rule("shipping follows the threshold", F.col("shipping_c") != ops.shipping(F.col("net_c")), key),
            Rule("customer and date are present", F.col("customer_key").isNull() | F.col("order_date").isNull(), key),
        ],
        [
            Grain(
                "customer", {"customer_key": F.col("customer_key")}, {"firsts": first.cast("int")},
                least={"first_day": F.col("order_date")}, most={"flagged_day": F.when(first, F.col("order_date"))},
            )
        ],
        "rules-orders",
    )
    who = F.col("customer_key")
    customers = RolledUp(
        orders.grain("customer"),
        [
            Rule("a customer has one first order", F.coalesce("firsts", F.lit(0)) != 1, who),
            Rule("the first order is on the first day", F.col("flagged_day") != F.col("first_day"), who),
        ],
        [],
        "rules-customers",
    )
    return _suite(orders.violations().unionByName(customers.violations()), ORDER_RULES)


LINE_RULES = [
    Told("quantity is positive"), Told("net is gross less discount"), Told("discount does not exceed gross"),
    Told("cost does not exceed gross", q.FINDING),
]


def dq_star_lines(star: Star, params: Params) -> DataFrame:
    rows = star.lines("order_line_key", "quantity", "gross_c", "discount_c", "net_c", "unit_cost_c")
    key = F.col("order_line_key")
    lines = RolledUp(
        rows,
        [
            Rule("quantity is positive", F.coalesce(F.col("quantity") <= 0, F.lit(True)), key),
            Rule("net is gross less discount", _off(F.col("net_c") - (F.col("gross_c") - F.col("discount_c")), 1), key),
            Rule("discount does not exceed gross", (F.col("discount_c") < 0) | (F.col("discount_c") > F.col("gross_c")), key),
            Rule("cost does not exceed gross", F.col("unit_cost_c") * F.col("quantity") > F.col("gross_c"), key),
        ],
        [],
        "rules-lines",
    )
    return _suite(lines.violations(), LINE_RULES)


RETURN_RULES = [
    Told("returned five to 21 days after the order"), Told("no more units than sold"), Told("refund within the line's net"),
    Told("a fee for changed minds only"), Told("completed after five days"), Told("every reason occurs", q.FINDING),
]


def dq_star_returns(star: Star, params: Params) -> DataFrame:
    back = star.returns(
        "return_key", "order_key", "order_line_key", "return_date", "return_reason_key", "return_quantity", "refund_c", "fee_c", "refund_completed_flag"
    )
    lines = star.lines("order_line_key", "quantity", "net_c").withColumnRenamed("order_line_key", "of_line")
    heads = star.orders("order_key", "order_date").withColumnRenamed("order_key", "of_order")
    reasons = star.return_reasons().select(F.col("return_reason_key").alias("of_reason"), "reason_code")
    rows = (
        back.join(lines, F.col("order_line_key") == F.col("of_line"), "left")
        .join(heads, F.col("order_key") == F.col("of_order"), "left")
        .join(reasons, F.col("return_reason_key") == F.col("of_reason"), "left")
    )
    key, changed = F.col("return_key"), F.col("reason_code") == "CHANGED_MIND"
    lag = F.datediff("return_date", "order_date")
    fee = F.when(changed, half_up_percent(F.col("refund_c"), F.lit(ops.RESTOCKING_PERCENT))).otherwise(0)
    due = ops.refund_completed(F.col("return_date"), F.lit(star.horizon))
    returns = RolledUp(
        rows,
        [
            Rule("returned five to 21 days after the order", ~lag.between(*RETURN_DAYS), key),
            Rule("no more units than sold", (F.col("return_quantity") <= 0) | (F.col("return_quantity") > F.col("quantity")), key),
            Rule("refund within the line's net", F.col("refund_c") > F.col("net_c") + 1, key),
            Rule("a fee for changed minds only", _off(F.col("fee_c") - fee, 1), key),
            Rule("completed after five days", F.col("refund_completed_flag") != due, key),
        ],
        [Grain("reason", {"return_reason_key": F.col("return_reason_key")})],
        "rules-returns",
    )
    used = returns.grain("reason").select("return_reason_key", F.col("n").alias("times"))
    reasons = RolledUp(
        star.return_reasons().select("return_reason_key").join(used, "return_reason_key", "left"),
        [Rule("every reason occurs", F.col("times").isNull(), F.col("return_reason_key"))],
        [],
        "rules-reasons",
    )
    return _suite(returns.violations().unionByName(reasons.violations()), RETURN_RULES)


SNAPSHOT_RULES = [
    Told("a month ends on its last day"), Told("age is not negative"), Told("recency is known from the first order on"),
    Told("30 days lie in 90 days lie in all"), Told("value is not negative", q.FINDING), Told("active within 90 days"),
    Told("at risk from 61 to 90 days"), Told("repeat from two orders"), Told("months follow one another"), Told("age grows"),
    Told("orders never fall"), Told("no order, no value"), Told("series run from signup to the horizon"),
]


def dq_star_snapshot(star: Star, params: Params) -> DataFrame:
    # A customer has as many rows as the calendar has months.
    series = Window.partitionBy("customer_key").orderBy("month_end")
    rows = star.snapshot().select(
        "*",
        F.lag("month_end").over(series).alias("before"),
        F.lag("customer_age_days").over(series).alias("age_before"),
        F.lag("cumulative_orders_to_date").over(series).alias("orders_before"),
    )
    key = F.concat_ws(" ", "customer_key", "month_end")
    recency, orders = F.col("recency_days"), F.col("cumulative_orders_to_date")
    near = F.coalesce(recency <= ACTIVE_DAYS, F.lit(False))
    known = recency.isNotNull() & F.col("months_since_first_purchase").isNotNull()
    unknown = recency.isNull() & F.col("months_since_first_purchase").isNull()
    snapshot = RolledUp(
        rows,
        [
            Rule("a month ends on its last day", F.col("month_end") != F.last_day("month_end"), key),
            Rule("age is not negative", F.col("customer_age_days") < 0, key),
            Rule(
                "recency is known from the first order on",
                ((orders == 0) & ~unknown) | ((orders > 0) & ~known) | F.coalesce((recency < 0) | (F.col("months_since_first_purchase") < 0), F.lit(False)),
                key,
            ),
            Rule("30 days lie in 90 days lie in all", (F.col("orders_last_30_days") > F.col("orders_last_90_days")) | (F.col("orders_last_90_days") > orders), key),
            Rule("value is not negative", F.col("cumulative_net_c") < 0, key),
            Rule("active within 90 days", F.col("is_active_flag") != near, key),
            Rule("at risk from 61 to 90 days", F.col("churn_risk_flag") != (near & (recency > RISK_DAYS)), key),
            Rule("repeat from two orders", F.col("is_repeat_customer_flag") != (orders >= 2), key),
            Rule("months follow one another", month_index(F.col("month_end")) - month_index(F.col("before")) != 1, key),
            Rule("age grows", F.col("customer_age_days") <= F.col("age_before"), key),
            Rule("orders never fall", orders < F.col("orders_before"), key),
            Rule("no order, no value", (orders == 0) & ((F.col("cumulative_net_c") != 0) | (F.col("rolling_12mo_c") != 0)), key),
        ],
        [Grain("customer", {"customer_key": F.col("customer_key")}, least={"first_month": F.col("month_end")}, most={"last_month": F.col("month_end")})],
        "rules-snapshot",
    )
    spans = star.customers("customer_key", "signup_date").join(snapshot.grain("customer"), "customer_key", "left")
    whole = (month_index(F.col("first_month")) == month_index(F.col("signup_date"))) & (F.col("last_month") == F.lit(star.horizon))
    customers = RolledUp(
        spans, [Rule("series run from signup to the horizon", ~F.coalesce(whole, F.lit(False)), F.col("customer_key"))], [], "rules-series"
    )
    return _suite(snapshot.violations().unionByName(customers.violations()), SNAPSHOT_RULES)


DIMENSION_RULES = [
    Told("campaign names are unique"), Told("campaigns end after they start"), Told("depth follows the campaign's name"),
    Told("campaigns run every year"), Told("customers sign up by the horizon"), Told("customer ids are unique"),
    Told("emails look like emails"), Told("prices and costs are positive"), Told("costs do not exceed prices"),
    Told("product ids are unique"), Told("reasons of both kinds"),
]


def dq_star_dimensions(star: Star, params: Params) -> DataFrame:
    spark = star.spark
    email = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
    campaigns = star.campaigns().select("campaign_key", "campaign_name", "start_date", "end_date", "discount_depth")
    depths = spark.createDataFrame(CAMPAIGN_DEPTHS, "prefix string, allowed array<string>")
    matched = q.with_longest_prefix(campaigns, "campaign_name", depths)
    of_campaigns = RolledUp(
        matched,
        [
            Rule("campaigns end after they start", F.col("end_date") < F.col("start_date"), F.col("campaign_key")),
            Rule("depth follows the campaign's name", ~F.coalesce(F.array_contains("allowed", F.col("discount_depth")), F.lit(False)), F.col("campaign_key")),
        ],
        [
            Grain("name", {"campaign_name": F.col("campaign_name")}),
            Grain("run", {"prefix": F.col("prefix"), "year": F.year("start_date")}, when=F.col("prefix").isNotNull()),
        ],
        "rules-campaigns",
    )
    repeated = of_campaigns.grain("name").filter("n > 1").select(
        F.lit("campaign names are unique").alias("check"), F.col("campaign_name").alias("key"), (F.col("n") - 1).alias("n")
    )
    # Few rows: one per campaign and year.
    runs = of_campaigns.grain("run")
    due = runs.agg(F.count_distinct("year")).scalar()
    missing = runs.groupBy("prefix").agg(F.count("*").alias("present")).withColumn("due", due).filter("present < due").select(
        F.lit("campaigns run every year").alias("check"), F.col("prefix").alias("key"), (F.col("due") - F.col("present")).alias("n")
    )
    who = star.customers("customer_key", "customer_id", "email", "signup_date")
    of_customers = RolledUp(
        who,
        [
            Rule("customers sign up by the horizon", F.coalesce(F.col("signup_date") > F.lit(star.horizon), F.lit(True)), F.col("customer_key")),
            Rule("emails look like emails", ~F.coalesce(F.rlike("email", F.lit(email)), F.lit(False)), F.col("customer_key")),
        ],
        [Grain("id", {"customer_id": F.col("customer_id")})],
        "rules-who",
    )
    goods = star.products("product_key", "product_id", "list_price", "unit_cost")
    of_products = RolledUp(
        goods,
        [
            Rule("prices and costs are positive", F.coalesce((F.col("list_price") <= 0) | (F.col("unit_cost") <= 0), F.lit(True)), F.col("product_key")),
            Rule("costs do not exceed prices", F.col("unit_cost") > F.col("list_price"), F.col("product_key")),
        ],
        [Grain("id", {"product_id": F.col("product_id")})],
        "rules-goods",
    )

    def twice(rolled: RolledUp, id_col: str, rule: str) -> DataFrame:
        return rolled.grain("id").filter("n > 1").select(F.lit(rule).alias("check"), F.col(id_col).alias("key"), (F.col("n") - 1).alias("n"))

    kinds = star.return_reasons().agg(F.count_distinct("is_controllable").alias("k")).select(
        F.lit("reasons of both kinds").alias("check"), F.lit(None).cast("string").alias("key"), (F.col("k") != 2).cast("bigint").alias("n")
    )
    looked = ck.looked_at(spark, ["campaign names are unique", "campaigns run every year", "customer ids are unique", "product ids are unique"])
    return _suite(
        q.union_all([
            of_campaigns.violations(), repeated, missing, of_customers.violations(), twice(of_customers, "customer_id", "customer ids are unique"),
            of_products.violations(), twice(of_products, "product_id", "product ids are unique"), kinds, looked,
        ]),
        DIMENSION_RULES,
    )


SUITES = {f.__name__: f for f in (dq_star_orders, dq_star_lines, dq_star_returns, dq_star_snapshot, dq_star_dimensions)}
