"""One planted fault per operator must be found, and nothing else."""

import datetime as dt

from pyspark.sql import functions as F

from merchlens.operators import quality as q

D = dt.date


def test_orphans_tell_null_from_dangling(spark):
    child = spark.createDataFrame([(1,), (1,), (None,), (9,)], "fk bigint")
    parent = spark.createDataFrame([(1,)], "pk bigint")
    assert q.fk_orphans(child, "fk", parent, "pk", "r").first().orphans == 1


def test_keys_and_grain(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (None, "b")], "k bigint, g string")
    row = q.pk_unique(df, "k", "t").first()
    assert (row.row_count, row.distinct_keys, row.null_keys, row.status) == (4, 2, 1, q.FAIL)
    assert q.grain_unique(df, ["k", "g"], "t").first().surplus_rows == 1
    nulls = {r.column_name: r.nulls for r in q.not_null(df, ["k", "g"], "t").collect()}
    assert nulls == {"k": 1, "g": 0}


def test_domain_pattern_and_row_rules(spark):
    df = spark.createDataFrame([("F", "AB-1", 1), ("X", "ab-1", -1), ("X", "AB-2", None)], "s string, c string, n int")
    row = q.domain_values(df, "s", ["F", "O"], "s").first()
    assert (row.unexpected_values, row.unexpected_rows, row.missing_values) == (1, 2, 1)
    assert q.pattern(df, "c", "^[A-Z]+-[0-9]$", "c").first().violations == 1
    # A rule that cannot be decided for a row is broken by it.
    assert q.row_rules(df, {"positive": F.col("n") > 0}, "t").first().violations == 2


def test_reconciliation(spark):
    parent = spark.createDataFrame([(1, 100), (2, 200), (3, 300)], "k bigint, a bigint")
    child = spark.createDataFrame([(1, 60), (1, 40), (2, 150), (4, 1)], "k bigint, a bigint")
    row = q.reconcile_groups(parent, child, "k", "a", 1, "r").first()
    assert (row.mismatched, row.without_children, row.without_parent) == (1, 1, 1)
    one = lambda v: spark.createDataFrame([(v,)], "total bigint")
    got = {r.path: r.status for r in q.reconcile_totals({"a": one(10), "b": one(12), "c": one(20)}, 5).collect()}
    assert got == {"a": q.PASS, "b": q.PASS, "c": q.FAIL}


def test_series(spark):
    rows = [(1, 1), (1, 2), (1, 2), (1, 4), (2, 2), (2, 3), (2, 4)]
    df = spark.createDataFrame(rows, "k bigint, m int")
    row = q.series_continuity(df, "k", F.col("m"), F.lit(1), F.lit(4)).first()
    assert (row.series, row.gaps, row.duplicates, row.wrong_starts, row.wrong_ends) == (2, 1, 1, 1, 0)
    falls = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (1, 3, 4), (2, 1, 1)], "k bigint, m int, v int")
    assert q.monotonic(falls, "k", "m", {"v": False}).first().violations == 1
    assert q.monotonic(falls, "k", "m", {"v": True}).first().violations == 2


def test_shape_counts_density(spark):
    df = spark.createDataFrame([(0,), (1,), (3,)], "k bigint")
    got = {r.column_name: r.status for r in q.schema_shape(spark, {"t": df}, {"t": "k int, x string"}).collect()}
    assert got == {"k": q.FAIL, "x": q.FAIL}
    assert q.row_count(df, 4, "t").first().status == q.FAIL
    assert q.dense_key(df, "k", 0, "k").first().status == q.FAIL
    assert q.dense_key(df.filter("k < 2"), "k", 0, "k").first().status == q.PASS


def test_distribution_coverage_range_and_spots(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1))] * 3 + [("b", D(2025, 1, 1))], "g string, d date")
    got = {r.group_value: r.status for r in q.distribution(df, "g", {"a": 75.0, "b": 40.0, "c": 1.0}, 5.0, "g").collect()}
    assert got == {"a": q.PASS, "b": q.FAIL, "c": q.PASS}
    parent = spark.createDataFrame([("a",), ("z",)], "pk string")
    row = q.key_coverage(parent, "pk", df, "g", "r").first()
    assert (row.parents, row.unused, row.status) == (2, 1, q.FINDING)
    assert q.date_range(df, "d", F.lit(D(2024, 1, 1)), F.lit(D(2024, 12, 31)), "d").first().out_of_range == 1
    spots = q.spot_rows(df.limit(1), "d", {D(2024, 1, 1): {"g": "a"}, D(2030, 1, 1): {"g": "a"}}).collect()
    assert {(r.key, r.status) for r in spots} == {("2024-01-01", q.PASS), ("2030-01-01", q.FAIL)}


def test_negative_months_need_a_reason(spark):
    snap = spark.createDataFrame([(1, 30, -5), (2, 30, -5), (3, 30, 5)], "customer_key bigint, m int, rolling_12mo_c bigint")
    refunds = spark.createDataFrame([(1, 17, 20), (2, 25, 26)], "customer_key bigint, order_m int, return_m int")
    row = q.explained_negatives(snap, refunds, F.col("m"), 12).first()
    assert (row.negative_rows, row.unexplained) == (2, 1)


def test_disagreements_and_roll_up(spark):
    a = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k bigint, v bigint")
    b = spark.createDataFrame([(1, 5), (2, 6), (4, 7)], "k bigint, v bigint")
    row = q.disagreements(a, b, ["k"], ["v"]).first()
    assert (row.compared_rows, row.only_first, row.only_second, row.v) == (4, 1, 1, 1)
    checks = spark.createDataFrame(
        [("1", "BLOCKING", "PASS"), ("1", "ADVISORY", "FINDING"), ("2", "ADVISORY", "FAIL")],
        "tier string, severity string, status string",
    )
    got = {r.tier: r for r in q.results(checks).collect()}
    assert got["1"].overall == "CERTIFIED" and got["1"].findings == 1
    assert got["2"].overall == got["all"].overall == "NOT CERTIFIED" and got["all"].checks == 3
