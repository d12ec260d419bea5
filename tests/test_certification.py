"""The certification of a star: planted faults, evidence, verdicts and the gate, on both kinds of star."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from merchlens import RetailStar, StoredStar
from merchlens.operators import checks as ck
from merchlens.params import RETAIL_PARAMS
from merchlens.plans import certification
from merchlens.session import scratch_path
from merchlens.sources.publish import publish_star


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    root = scratch_path(spark, "certified")
    publish_star(RetailStar(spark, sf_dir), root)
    return StoredStar(spark, root)


def _checks(star):
    return {r.check_id: r for r in certification.certify(star, RETAIL_PARAMS).collect()}


@pytest.fixture(scope="module")
def fine(stored):
    return _checks(stored)


def test_both_kinds_of_star_give_the_same_checks(spark, sf_dir, fine):
    assert len(fine) == 62 and not [r for r in fine.values() if r.evidence == "not made"]
    assert _checks(RetailStar(spark, sf_dir)) == fine


class _Broken(StoredStar):
    """A stored star with faults put into what it hands out: a table's name to a change of its frame."""

    def __init__(self, spark, root, **faults):
        super().__init__(spark, root)
        self.faults = faults

    def table(self, name):
        df = super().table(name)
        return self.faults[name](df) if name in self.faults else df


def _set(column, key, value, to):
    return lambda df: df.withColumn(column, F.when(F.col(key) == value, to).otherwise(F.col(column)).cast(df.schema[column].dataType))


def _faults(stored):
    """Each fault with the checks that must name the key."""
    order = stored.table("fact_orders").orderBy("order_key").first()
    line = stored.table("fact_order_lines").orderBy("order_line_key").first()
    back = stored.table("fact_returns").orderBy("return_key").first()
    day = dt.date(1996, 3, 4)
    snap = stored.table("fact_customer_monthly_snapshot").orderBy("customer_key", "snapshot_month_date_key").first()
    o, ln, r = str(order.order_key), line.order_line_key, back.return_key
    return {
        "order net": ({"fact_orders": _set("net_revenue", "order_key", order.order_key, F.col("net_revenue") + 1)},
                      {"1.5": o, "2.1": "", "2.6": str(order.customer_key), "1.9": ""}),
        "order twice": ({"fact_orders": lambda df: df.unionByName(df.filter(F.col("order_key") == order.order_key))}, {"0.2": f"order {o}"}),
        "order without customer": ({"fact_orders": _set("customer_key", "order_key", order.order_key, F.lit(987654321))},
                                   {"0.1": "fact_orders.customer_key 987654321", "1.4": o}),
        "order without lines": ({"fact_order_lines": lambda df: df.filter(F.col("order_key") != order.order_key)}, {"2.2": o}),
        "line of a lost order": ({"fact_order_lines": _set("order_key", "order_line_key", ln, F.lit(987654321))},
                                 {"0.1": "fact_order_lines.order_key 987654321", "2.2": "987654321"}),
        "line cost": ({"fact_order_lines": _set("unit_cost", "order_line_key", ln, F.col("unit_cost") + 1)}, {"1.3": ln}),
        "line twice": ({"fact_order_lines": lambda df: df.unionByName(df.filter(F.col("order_line_key") == ln))}, {"0.2": f"line {ln}"}),
        "two returns of a line": ({"fact_returns": lambda df: df.unionByName(df.filter(F.col("return_key") == r).withColumn("return_key", F.lit("z")))},
                                  {"0.3": f"line {back.order_line_key}"}),
        "refund": ({"fact_returns": _set("return_amount", "return_key", r, F.col("return_amount") + 5)}, {"1.6": r}),
        "units": ({"fact_returns": _set("return_quantity", "return_key", r, F.lit(9999))}, {"1.6": r, "2.3": r}),
        "early return": ({"fact_returns": _set("return_date_key", "return_key", r, F.lit(19920101))}, {"0.5": r}),
        "reason": ({"fact_returns": _set("return_reason_key", "return_key", r, F.lit(77))}, {"0.1": "fact_returns.return_reason_key 77"}),
        "signup": ({"dim_customer": _set("signup_date", "customer_key", order.customer_key, F.lit(dt.date(2000, 1, 1)))},
                   {"1.2": str(order.customer_key), "1.10": str(order.customer_key)}),
        "home": ({"dim_customer": _set("home_geography_key", "customer_key", order.customer_key, F.lit(77))},
                 {"1.1": str(order.customer_key)}),
        "snapshot month twice": ({"fact_customer_monthly_snapshot": lambda df: df.unionByName(df.filter(F.col("snapshot_key") == snap.snapshot_key))},
                                 {"0.2": f"snapshot {snap.customer_key} ", "0.3": f"snapshot {snap.customer_key} "}),
        "no series": ({"fact_customer_monthly_snapshot": lambda df: df.filter(F.col("customer_key") != snap.customer_key)},
                      {"4a.1": str(snap.customer_key)}),
        "snapshot orders": ({"fact_customer_monthly_snapshot": _set("cumulative_orders_to_date", "customer_key", snap.customer_key, F.lit(99))},
                            {"2.5": str(snap.customer_key)}),
        "day lost": ({"dim_date": lambda df: df.filter(F.col("full_date") != F.lit(day))}, {"D.6": "1996-03-04", "D.1": ""}),
        "day misspelt": ({"dim_date": _set("date_key", "full_date", F.lit(day), F.lit(19960399))}, {"D.5": "1996-03-04"}),
        "day twice": ({"dim_date": lambda df: df.unionByName(df.filter(F.col("full_date") == F.lit(day)))}, {"D.3": "day 1996-03-04"}),
        "no reasons": ({"dim_return_reason": lambda df: df.limit(0)}, {"4a.2": "dim_return_reason", "0.1": "fact_returns.return_reason_key 1"}),
    }


# Faults that do not hide each other are planted together.
GROUPS = [
    ("order net", "line cost", "two returns of a line", "home", "day lost", "snapshot month twice"),
    ("order without customer", "line twice", "refund", "signup", "day misspelt", "no series"),
    ("order without lines", "units", "reason", "day twice", "snapshot orders"),
    ("order twice", "line of a lost order", "early return", "no reasons"),
]


def test_every_fault_is_in_a_group(stored):
    assert sorted(n for g in GROUPS for n in g) == sorted(_faults(stored))


@pytest.mark.parametrize("group", range(len(GROUPS)))
def test_a_planted_fault_is_found_and_names_its_key(spark, stored, fine, group):
    faults = _faults(stored)
    tables, wanted = {}, []
    for name in GROUPS[group]:
        changes, checks = faults[name]
        for table, change in changes.items():
            before = tables.get(table)
            tables[table] = change if before is None else (lambda df, a=before, b=change: b(a(df)))
        wanted += [(name, *w) for w in checks.items()]
    found = _checks(_Broken(spark, stored.root, **tables))
    for name, check, key in wanted:
        row = found[check]
        assert row.status == "FAIL" and row.violations > fine[check].violations, (name, row)
        assert key in row.evidence, (name, row)


def test_evidence_is_the_smallest_keys_numbers_first(spark):
    rows = [("a", str(k), 1) for k in range(300, 0, -1)] + [("a", "x", 1), ("b", "z", 2), ("b", "y", 1), ("c", None, 0), ("d", "q", 0)]
    found = {r.check: r.evidence for r in ck.smallest_keys(spark.createDataFrame(rows, ck.VIOLATIONS).repartition(5)).collect()}
    assert found == {"a": "1, 2, 3, 4, 5", "b": "y, z"}


def _judged(spark, violations, told=()):
    written = [("a", "1", "BLOCKING", "A", "FAIL"), ("b", "1", "ADVISORY", "B", "FINDING"), ("c", "2", "ADVISORY", "C", "FINDING")]
    checks = spark.createDataFrame(written, "check_id string, tier string, severity string, name string, on_violation string")
    told = spark.createDataFrame(list(told), "check string, evidence string, verdict string")
    return ck.judged(checks, spark.createDataFrame(violations, ck.VIOLATIONS), told)


def test_verdicts_are_apart_from_severity(spark):
    rows = {r.check_id: r for r in _judged(spark, [("a", None, 0), ("b", "k", 3)], [("c", "7", "FAIL")]).collect()}
    assert {c: (r.status, r.violations, r.evidence) for c, r in rows.items()} == {
        "a": ("PASS", 0, ""), "b": ("FINDING", 3, "k"), "c": ("FAIL", 1, "7"),
    }
    # A check that nothing looked at fails, though it is advisory and no violation was counted.
    rows = {r.check_id: r for r in _judged(spark, [("a", None, 0)], [("c", "7", "PASS"), ("C", "1", "FAIL")]).collect()}
    assert {c: (r.status, r.evidence) for c, r in rows.items()} == {"a": ("PASS", ""), "b": ("FAIL", "not made"), "c": ("PASS", "7")}


def test_the_gate(spark, stored):
    assert ck.require_certified(_judged(spark, [("a", None, 0), ("b", "k", 3)], [("c", "7", "PASS")])) == 1
    with pytest.raises(ck.NotCertified, match="a A: 2 .k") as denied:
        ck.require_certified(_judged(spark, [("a", "k", 2), ("b", None, 0)], [("c", "7", "FAIL")]))
    assert [r.check_id for r in denied.value.failed] == ["a", "c"]
    # The small star breaks a claim about the business, so it is not certified.
    with pytest.raises(ck.NotCertified, match="5.1"):
        certification.gate(stored, RETAIL_PARAMS)


def test_facts_are_read_twice_at_most(spark, stored):
    reads = {}

    class Counted(StoredStar):
        def table(self, name):
            reads[name] = reads.get(name, 0) + 1
            return super().table(name)

    certification.certify(Counted(spark, stored.root), RETAIL_PARAMS)
    large = {n: k for n, k in reads.items() if n.startswith("fact_") or n in ("dim_customer", "dim_product")}
    # One row of each dimension is looked at besides.
    assert large == {
        "fact_orders": 2, "fact_order_lines": 2, "fact_returns": 2, "fact_customer_monthly_snapshot": 2, "dim_customer": 3, "dim_product": 3,
    }


def test_rules_and_grains_of_one_pass(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, "a", -1), (3, "b", None), (4, None, -7)], "k int, g string, v int")
    rolled = ck.RolledUp(
        rows,
        [ck.Rule("r1", F.col("v") < 0, F.col("k")), ck.Rule("r2", F.col("v") > 100, F.col("k")), ck.Rule("r1", F.col("g").isNull(), F.col("k"), F.lit(4))],
        [
            ck.Grain("g", {"g": F.col("g")}, {"v": F.col("v")}, least={"low": F.col("k")}, most={"high": F.col("k")}),
            ck.Grain("positive", {"sign": F.signum("v")}, {"total": F.col("v")}, when=F.col("v") > 0),
        ],
        "test",
    )
    assert sorted(map(tuple, rolled.grain("g").collect()), key=str) == [("a", 2, 4, 1, 2), ("b", 1, None, 3, 3), (None, 1, -7, 4, 4)]
    assert [tuple(r) for r in rolled.grain("positive").collect()] == [(1.0, 1, 5)]
    counts = {r.check: r.n for r in rolled.violations().groupBy("check").agg(F.sum("n").alias("n")).collect()}
    assert counts == {"r1": 6, "r2": 0}


def test_keys_are_counted_in_generated_code(stored):
    from merchlens.plans.ledger import Ledger

    keys = Ledger(stored).key_checks(certification._UNUSED)
    plan = keys._jdf.queryExecution().executedPlan().toString()
    # Lists of users, of which every key had one, were collected by sorts.
    assert "ObjectHashAggregate" not in plan and "collect_list" not in plan


def test_lines_are_dealt_out_by_product_and_by_order_only(spark, sf_dir, monkeypatch):
    from merchlens.plans.ledger import Ledger

    plans = {}

    def planned(df, label, lean=False):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return df.limit(0)

    monkeypatch.setattr(ck, "stage", planned)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        Ledger(RetailStar(spark, sf_dir)).lines
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    dealt = re.findall(r"Exchange hashpartitioning\(([^()]*)#", plans["ledger-lines"])
    # Raw lines by product, twice products, lines and returns by order, orders for each, and the sums.
    by = sorted(re.sub(r"#\d+L?", "", d) for d in dealt if not d.startswith("grain"))
    assert by == ["l_orderkey", "l_orderkey", "l_partkey", "order_key", "order_key", "p_key", "product_key"], by


def test_a_return_that_names_another_order_or_no_line_still_counts(spark, stored, fine):
    first, lost = (r.return_key for r in stored.table("fact_returns").orderBy("return_key").limit(2).collect())
    back = stored.table("fact_returns").filter(F.col("return_key") == first).first()
    other = stored.table("fact_orders").filter(F.col("order_key") != back.order_key).orderBy("order_key").first().order_key

    def change(df):
        df = _set("order_key", "return_key", first, F.lit(other))(df)
        return _set("order_line_key", "return_key", lost, F.lit("none"))(df)

    star = _Broken(spark, stored.root, fact_returns=change)
    found = _checks(star)
    # The line of the first is found in its own order, and differs in the order only; the second has none.
    assert (found["1.6"].violations, found["1.6"].evidence) == (1, first)
    assert (found["0.1"].violations, found["0.1"].evidence) == (1, "fact_returns.order_line_key none")
    changed = {c for c, r in found.items() if r != fine[c]}
    assert changed == {"0.1", "1.6"}, {c: found[c] for c in changed}
    ledger = certification.Ledger(star)
    sums = ledger.lines.grain("order").agg(F.sum("l_rows"), F.sum("r_rows"), F.sum("refund_c")).first()
    refunds = stored.returns("refund_c").agg(F.count("*"), F.sum("refund_c")).first()
    assert tuple(sums) == (stored.lines("order_line_key").count(), *refunds)


def test_a_line_without_an_order_has_no_header_though_it_was_returned(spark, stored):
    back = stored.table("fact_returns").orderBy("return_key").first()
    star = _Broken(spark, stored.root, fact_order_lines=_set("order_key", "order_line_key", back.order_line_key, F.lit(None)))
    alone = stored.lines("order_key").filter(F.col("order_key") == back.order_key).count() == 1
    assert _checks(star)["2.2"].violations == 1 + alone


def test_keys_of_lines_and_other_keys_are_stored_apart(spark, sf_dir, stored, fine):
    from merchlens.plans.ledger import Ledger

    of_lines, others = (p._jdf.queryExecution().optimizedPlan().toString() for p in Ledger(RetailStar(spark, sf_dir)).key_parts(certification._UNUSED))
    # Neither customers nor the months of the snapshot are read for keys of lines, and these are not made for the others.
    assert "Relation [c_custkey" not in of_lines and "sequence(" not in of_lines and "concat_ws(-" in of_lines
    assert "Relation [c_custkey" in others and "sequence(" in others and "concat_ws(-" not in others
    # Both are looked at: a line and an order that are there twice are named under one check.
    line = stored.table("fact_order_lines").orderBy("order_line_key").first().order_line_key
    order = stored.table("fact_orders").orderBy("order_key").first().order_key
    star = _Broken(
        spark, stored.root,
        fact_order_lines=lambda df: df.unionByName(df.filter(F.col("order_line_key") == line)),
        fact_orders=lambda df: df.unionByName(df.filter(F.col("order_key") == order)),
    )
    row = _checks(star)["0.2"]
    assert (row.violations, row.evidence) == (2, f"line {line}, order {order}")
