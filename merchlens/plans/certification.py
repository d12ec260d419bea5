"""Certification of a whole star: 62 checks in one table, and their roll-up.

A check is data: an id, a tier, a severity, a name and the verdict that a
violation means, which is not the severity's to say. What counts its violations
is a rule of a pass over a fact (``plans.ledger``), or an expression over the
star's totals, or a claim that states its own verdict; a check that nothing
counted fails. Every fact, and the customers and products, are read twice: once
for their keys, once for their rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.operators import checks as ck
from merchlens.operators import quality as q
from merchlens.params import Params
from merchlens.plans.ledger import Ledger
from merchlens.plans.quality import claims, readiness
from merchlens.session import stage
from merchlens.sources.star import Star

BLOCKING, ADVISORY = "BLOCKING", "ADVISORY"


@dataclass(frozen=True)
class Check:
    id: str
    tier: str
    severity: str
    name: str
    # Violations as an expression over totals, beside those that rules count; none where rules or claims alone do.
    totals: str | None = None
    # What a violation means: a defect, or something to report.
    on_violation: str = q.FAIL


def _b(i: str, tier: str, name: str, totals: str | None = None) -> Check:
    return Check(i, tier, BLOCKING, name, totals)


def _a(i: str, tier: str, name: str) -> Check:
    return Check(i, tier, ADVISORY, name, on_violation=q.FINDING)


# Amounts are in cents: a tolerance of 5 is five cents.
CHECKS = [
    _b("D.1", "SMOKE", "calendar has one row per day of its span", "abs(d_rows - d_span)"),
    _b("D.2", "SMOKE", "date_key is present and unique"),
    _b("D.3", "SMOKE", "full_date is present and unique"),
    _b("D.4", "SMOKE", "calendar columns are never NULL"),
    _b("D.5", "SMOKE", "date_key spells full_date"),
    _b("D.6", "SMOKE", "calendar has no missing day"),
    _b("D.7", "SMOKE", "calendar spans the observed period", "int(d_first <> d_start) + int(d_last <> d_end)"),
    _b("0.1", "0", "every foreign key of every fact resolves"),
    _b("0.2", "0", "primary keys of the facts are unique"),
    _b("0.3", "0", "one return per line, one snapshot row per customer month"),
    _b("0.4", "0", "every fact date lies inside the calendar"),
    _b("0.5", "0", "no return precedes its order"),
    _b("1.1", "1", "orders carry their customer's geography and channel"),
    _b("1.2", "1", "no order precedes its customer's signup"),
    _b("1.3", "1", "lines carry their product's cost"),
    _b("1.4", "1", "lines carry their header's customer and date"),
    _b("1.5", "1", "header net equals the sum of its lines"),
    _b("1.6", "1", "refunds follow from the line they refund"),
    _b("1.7", "1", "attributed orders lie in their campaign's window"),
    _b("1.8", "1", "attributed orders lie on a campaign day"),
    _b("1.9", "1", "the final snapshot reflects orders and returns", "int(f_orders <> o_rows) + int(abs(f_value_c - (o_net_c - refund_c)) > 5)"),
    _b("1.10", "1", "every snapshot series starts in the signup month"),
    _b("2.1", "2", "header money equals line money", "int(abs(o_gross_c - l_gross_c) > 5) + int(abs(o_discount_c - l_discount_c) > 5) + int(abs(o_net_c - l_net_c) > 5)"),
    _b("2.2", "2", "every order has lines and every line a header"),
    _b("2.3", "2", "returned units never exceed sold units", "int(r_units > l_units)"),
    _b("2.4", "2", "refunds never exceed line revenue", "int(refund_c > l_net_c)"),
    _b("2.5", "2", "snapshot order counts equal the customers' orders"),
    _b("2.6", "2", "snapshot net revenue equals orders less returns"),
    _b("2.7", "2", "first-order flags equal the customers who ordered", "abs(o_firsts - c_buyers)"),
    _b("2.8", "2", "both facts agree on the first purchase month"),
    _b("3.1", "3", "net revenue agrees over lines, headers and snapshot", "int(abs(l_net_c - o_net_c) > 5) + int(abs(o_net_c - refund_c - f_value_c) > 5)"),
    _b("3.2", "3", "order value agrees over headers and lines", "int(abs(o_net_c - l_net_c) > o_rows)"),
    _b("3.3", "3", "repeat rate agrees over orders and snapshot", "abs(c_repeat - f_repeat)"),
    _b("3.4", "3", "return rate can be formed", "int(r_units <= 0) + int(l_units <= 0)"),
    _b("3.5", "3", "discount impact agrees over headers and lines", "int(abs(try_divide(100.0D * o_discount_c, o_gross_c) - try_divide(100.0D * l_discount_c, l_gross_c)) > 0.01D)"),
    _b("3.6", "3", "customer value agrees over snapshot and facts", "int(abs(c_value_c - f_value_c) > 5)"),
    _b("3.7", "3", "gross margin inputs are complete", "int(l_net_c <= l_cost_c)"),
    _b("4a.1", "4a", "every customer has a snapshot series"),
    _b("4a.2", "4a", "no dimension is empty"),
    _b("4a.3", "4a", "no fact is empty", "int(o_rows = 0) + int(l_rows = 0) + int(r_rows = 0) + int(s_rows = 0)"),
    _b("4a.4", "4a", "customers with an order are those with a first order", "abs(o_first_customers - c_buyers)"),
    _a("4b.1", "4b", "products never sold"),
    _a("4b.2", "4b", "campaigns without orders"),
    _a("4b.3", "4b", "marketing channels without customers"),
    _a("4b.4", "4b", "sales channels without orders"),
    _a("4b.5", "4b", "return reasons never used"),
    _a("4b.6", "4b", "geographies without customers"),
    _a("4b.7", "4b", "customers who never bought"),
    _b("5.1", "5", "revenue grows every year"),
    _b("5.2", "5", "the holiday months beat the others"),
    _b("5.3", "5", "no month has negative net revenue"),
    _b("5.4", "5", "the expected category has the highest return rate"),
    _a("5.5", "5", "repeat customers bring a minority of revenue"),
    _a("5.6", "5", "the repeat share grows every year"),
    _b("6.1", "6", "RFM inputs are complete"),
    _b("6.2", "6", "recency and value can be cut in five"),
    _b("6.3", "6", "every cohort has customers"),
    _b("6.4", "6", "churn labels can be derived, none beyond the horizon"),
    _b("6.5", "6", "both churn classes occur"),
    _b("6.6", "6", "enough customers to rank"),
    _b("6.7", "6", "no month without orders"),
    _b("6.8", "6", "lines fan out of orders"),
]


# Dimensions whose unused members are reported, each with its check.
_UNUSED = {
    "product": "4b.1", "campaign": "4b.2", "channel": "4b.3", "sales channel": "4b.4", "reason": "4b.5", "geography": "4b.6",
}


def _of_totals(totals: DataFrame, ids: list[str]) -> DataFrame:
    """(check, key, n) for checks over one row of totals; one that cannot be formed counts one."""
    rows = [
        F.struct(F.lit(c.id).alias("check"), F.lit(None).cast("string").alias("key"), F.coalesce(F.expr(c.totals).cast("bigint"), F.lit(1)).alias("n"))
        for c in CHECKS
        if c.id in ids
    ]
    return totals.select(F.inline(F.array(*rows)))


def certify(star: Star, params: Params) -> DataFrame:
    """check_id, tier, severity, name, violations, evidence, status for a star as it stands."""
    star.hold_facts(orders=True)
    ledger = Ledger(star)
    customers, days = ledger.customer_checks(), ledger.calendar_checks()
    totals = customers.grain("all").fillna(0)
    span = days.grain("all").withColumns(
        {
            "d_span": F.col("d_last") - F.col("d_first") + 1,
            "d_start": F.unix_date(F.lit(star.calendar_start)),
            "d_end": F.unix_date(F.lit(star.horizon)),
        }
    )
    of_days = [c.id for c in CHECKS if c.totals and c.tier == "SMOKE"]
    of_totals = [c.id for c in CHECKS if c.totals and c.tier != "SMOKE"]
    keys = [stage(part, "violations-of-keys", lean=True) for part in ledger.key_parts(_UNUSED)]
    # Written once: the counts and the evidence both read them.
    violations = stage(
        q.union_all([
            ledger.lines.violations(),
            ledger.orders.violations(),
            customers.violations(),
            days.violations(),
            *keys,
            ledger.empty_dimensions(),
            _of_totals(totals, of_totals),
            _of_totals(span, of_days),
        ]),
        "violations",
        lean=True,
    )
    months = ledger.orders.grain("customer month")
    said = claims(
        months.select("customer_key", "month", F.col("o_rows").alias("orders"), F.col("o_net_c").alias("net_c")),
        ledger.lines.grain("month"),
        ledger.lines.grain("category").select("category", F.col("l_units").alias("units"), F.col("r_units").alias("back")),
        params,
    )
    needed = readiness(
        ledger.customers,
        ledger.customers.filter("signup_date is not null").select("signup_date"),
        months.filter("o_rows > 0").select("month"),
        totals.select(F.col("l_rows").alias("lines"), F.col("o_rows").alias("orders")),
        star.horizon,
    )
    told = said.select("check", "evidence", F.col("status").alias("verdict")).unionByName(
        needed.select("check", F.col("measure").cast("string").alias("evidence"), F.col("status").alias("verdict"))
    )
    written = star.spark.createDataFrame(
        [(c.id, c.tier, c.severity, c.name, c.on_violation) for c in CHECKS],
        "check_id string, tier string, severity string, name string, on_violation string",
    )
    return ck.judged(written, violations, told)


def warehouse_checks(star: Star, params: Params) -> DataFrame:
    return certify(star, params)


def dq_results(star: Star, params: Params) -> DataFrame:
    return q.results(certify(star, params))


def gate(star: Star, params: Params) -> int:
    """Raise ``NotCertified`` unless every check of the star holds; otherwise the number of findings."""
    return ck.require_certified(certify(star, params))


SUITES = {"warehouse_checks": warehouse_checks, "dq_results": dq_results}
