"""Data-quality operators.

Each operator takes frames and a statement of what must hold, and returns the
counts that decide it. Keys are counted before they are joined or compared, so
a key that holds a large part of the rows costs one row after the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlens.operators.interval_join import interval_join

PASS, FAIL, FINDING = "PASS", "FAIL", "FINDING"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by halves: a chain would have the growing plan analysed once per frame."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return union_all(frames[:half]).unionByName(union_all(frames[half:]))


def verdict(violations: Column, otherwise: str = FAIL) -> Column:
    return F.when(violations == 0, PASS).otherwise(otherwise)


def _melt(one_row: DataFrame, name: str, value: str) -> DataFrame:
    return one_row.unpivot([], one_row.columns, name, value)


def _count(condition: Column) -> Column:
    """Rows where ``condition`` is true; zero for an empty table."""
    return F.count_if(condition)


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, label: str) -> DataFrame:
    """(relationship, orphans): child rows whose non-NULL key has no parent."""
    keys = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k")).agg(F.count("*").alias("_n"))
    missing = keys.join(parent.select(F.col(pk).alias("_k")), "_k", "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans")).select(
        F.lit(label).alias("relationship"), "orphans"
    )


def _per_key(df: DataFrame, *keys: Column) -> DataFrame:
    return df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("_n"))


def pk_unique(df: DataFrame, key: str, label: str) -> DataFrame:
    per = _per_key(df, F.col(key))
    known = F.col("_k0").isNotNull()
    return per.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        _count(known).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("null_keys"),
    ).select(
        F.lit(label).alias("table_name"),
        "*",
        verdict(F.col("row_count") - F.col("distinct_keys")).alias("status"),
    )


def grain_unique(df: DataFrame, grain: Sequence[str], label: str) -> DataFrame:
    """(grain, row_count, groups, surplus_rows): rows beyond one per grain value."""
    return _per_key(df, *[F.col(c) for c in grain]).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.count("*").alias("group_count")
    ).select(
        F.lit(label).alias("grain"),
        "*",
        (F.col("row_count") - F.col("group_count")).alias("surplus_rows"),
    )


def not_null(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    nulls = df.agg(*[_count(F.col(c).isNull()).alias(c) for c in columns])
    return _melt(nulls, "column_name", "nulls").select(F.lit(label).alias("table_name"), "*")


def domain_values(df: DataFrame, column: str, allowed: Sequence[str], label: str) -> DataFrame:
    """Values outside a closed list, their rows, and listed values never seen."""
    listed = df.sparkSession.createDataFrame([(v,) for v in allowed], "_k0 string").withColumn("_listed", F.lit(True))
    seen = _per_key(df, F.col(column).cast("string"))
    both = seen.join(listed, "_k0", "full")
    strange, unseen = F.col("_listed").isNull(), F.col("_n").isNull()
    return both.agg(
        _count(strange).alias("unexpected_values"),
        F.coalesce(F.sum(F.when(strange, F.col("_n"))), F.lit(0)).alias("unexpected_rows"),
        _count(unseen).alias("missing_values"),
    ).select(F.lit(label).alias("column_name"), "*")


def pattern(df: DataFrame, column: str, regex: str, label: str) -> DataFrame:
    return df.agg(_count(~F.col(column).rlike(regex)).alias("violations")).select(
        F.lit(label).alias("column_name"), F.lit(regex).alias("pattern"), "violations"
    )


def with_longest_prefix(df: DataFrame, name: str, rules: DataFrame) -> DataFrame:
    """Every row with the columns of the rule whose ``prefix`` is the longest that ``name`` begins with, or NULLs.

    ``rules``: prefix (each once) and what it allows. Names meet rules by an equi
    join on their beginnings, as long as the prefixes there are, so neither side
    has to be small; distinct names are matched once.
    """
    # A few: the lengths that prefixes have.
    lengths = [r[0] for r in rules.select(F.char_length("prefix")).distinct().collect()]
    names = df.select(F.col(name).alias("_name")).filter(F.col(name).isNotNull()).distinct()
    starts = F.array(*[F.when(F.char_length("_name") >= n, F.left("_name", F.lit(n))) for n in lengths] or [F.lit(None).cast("string")])
    allowed = [c for c in rules.columns if c != "prefix"]
    best = (
        names.select("_name", F.explode(F.array_compact(starts)).alias("prefix"))
        .join(rules, "prefix")
        .groupBy("_name")
        .agg(F.max_by(F.struct("prefix", *allowed), F.char_length("prefix")).alias("_rule"))
    )
    return df.join(best, F.col(name) == F.col("_name"), "left").select(*df.columns, "_rule.*")


def prefix_domain(df: DataFrame, name: str, value: str, rules: DataFrame, label: str) -> DataFrame:
    """(rule_set, prefix, rows, violations, status): values that their name's longest prefix does not allow.

    ``rules``: prefix, allowed (array). A name without a rule breaks none and is counted under a NULL prefix.
    """
    allowed = F.array_contains("allowed", F.col(value))
    rows = with_longest_prefix(df.select(name, value), name, rules)
    return (
        rows.groupBy("prefix")
        .agg(F.count("*").alias("rows"), _count(F.col("prefix").isNotNull() & ~F.coalesce(allowed, F.lit(False))).alias("violations"))
        .select(F.lit(label).alias("rule_set"), "prefix", "rows", "violations", verdict(F.col("violations")).alias("status"))
    )


def row_rules(df: DataFrame, rules: Mapping[str, Column], label: str) -> DataFrame:
    """(table_name, rule, violations): rows breaking each rule, in one pass.

    A rule that is NULL for a row is broken by it.
    """
    broken = df.agg(*[_count(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    return _melt(broken, "rule", "violations").select(F.lit(label).alias("table_name"), "*")


def cross_table_rules(
    child: DataFrame, parent: DataFrame, on: str, rules: Mapping[str, Column], label: str
) -> DataFrame:
    """Row rules over child rows with their parent's columns."""
    return row_rules(child.join(parent, on), rules, label)


def reconcile_groups(
    parent: DataFrame, child: DataFrame, key: str, measure: str, tolerance: int, label: str
) -> DataFrame:
    """Parent measure against the sum of its children, per key.

    Both sides are exact integers (cents); a side that is missing counts apart.
    """
    sums = child.groupBy(key).agg(F.sum(measure).alias("_child"))
    both = parent.select(key, F.col(measure).alias("_parent")).join(sums, key, "full")
    apart = F.abs(F.col("_parent") - F.col("_child")) > tolerance
    return both.agg(
        F.count("*").alias("group_count"),
        _count(apart).alias("mismatched"),
        _count(F.col("_child").isNull()).alias("without_children"),
        _count(F.col("_parent").isNull()).alias("without_parent"),
    ).select(F.lit(label).alias("relation"), "*")


def reconcile_totals(paths: Mapping[str, DataFrame], tolerance: int) -> DataFrame:
    """(path, total, status) for one-row frames ``total``; all must equal the first."""
    first = next(iter(paths))
    rows = union_all([df.select(F.lit(p).alias("path"), "total") for p, df in paths.items()])
    anchor = F.max(F.when(F.col("path") == first, F.col("total"))).over(Window.partitionBy())
    off = F.abs(F.col("total") - anchor) > tolerance
    return rows.select("*", F.when(~off, PASS).otherwise(FAIL).alias("status"))


def series_continuity(df: DataFrame, key: str, position: Column, first: Column, last: Column) -> DataFrame:
    """Gaps, duplicates and wrong ends of per-key integer series.

    ``position`` numbers the steps (months or days); ``first`` and ``last`` are
    where each series must begin and end. Extent and distinct count decide
    continuity, so no series is sorted.
    """
    steps = df.groupBy(key, position.alias("_p")).agg(
        F.count("*").alias("_n"), F.first(first).alias("_first"), F.first(last).alias("_last")
    )
    series = steps.groupBy(key).agg(
        F.count("*").alias("steps"),
        F.sum("_n").alias("row_count"),
        F.min("_p").alias("lo"),
        F.max("_p").alias("hi"),
        F.first("_first").alias("first"),
        F.first("_last").alias("last"),
    )
    return series.agg(
        F.count("*").alias("series"),
        F.sum("row_count").alias("row_count"),
        F.sum(F.col("hi") - F.col("lo") + 1 - F.col("steps")).alias("gaps"),
        F.sum(F.col("row_count") - F.col("steps")).alias("duplicates"),
        _count(F.col("lo") != F.col("first")).alias("wrong_starts"),
        _count(F.col("hi") != F.col("last")).alias("wrong_ends"),
    )


def monotonic(df: DataFrame, key: str, order: str, measures: Mapping[str, bool]) -> DataFrame:
    """(measure, violations): steps at which a measure falls, or for ``True``
    fails to grow. For series bounded per key, such as months of a customer."""
    w = Window.partitionBy(key).orderBy(order)

    def broken(m: str, strict: bool) -> Column:
        before = F.lag(m).over(w)
        return (F.col(m) <= before) if strict else (F.col(m) < before)

    steps = df.select(*[broken(m, strict).alias(m) for m, strict in measures.items()])
    return _melt(steps.agg(*[_count(F.col(m)).alias(m) for m in measures]), "measure", "violations")


def schema_shape(spark: SparkSession, tables: Mapping[str, DataFrame], declared: Mapping[str, str]) -> DataFrame:
    """(table_name, column_name, declared_type, actual_type, status) per column."""
    rows = []
    for name, ddl in declared.items():
        want = dict(c.strip().rsplit(" ", 1) for c in ddl.split(","))
        have = dict(tables[name].dtypes)
        for column in dict.fromkeys([*want, *have]):
            a, b = want.get(column), have.get(column)
            rows.append((name, column, a, b, PASS if a == b else FAIL))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, declared_type string, actual_type string, status string"
    )


def row_count(df: DataFrame, minimum: int, label: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(label).alias("table_name"),
        "row_count",
        F.lit(minimum).cast("bigint").alias("minimum"),
        F.when(F.col("row_count") >= minimum, PASS).otherwise(FAIL).alias("status"),
    )


def dense_key(df: DataFrame, key: str, start: int, label: str) -> DataFrame:
    """Whether a key runs without gap or repeat from ``start``."""
    dense = (
        (F.col("min_key") == start)
        & (F.col("max_key") == start + F.col("row_count") - 1)
        & (F.col("distinct_keys") == F.col("row_count"))
    )
    return _per_key(df, F.col(key).cast("bigint")).agg(
        F.min("_k0").alias("min_key"),
        F.max("_k0").alias("max_key"),
        F.sum("_n").alias("row_count"),
        _count(F.col("_k0").isNotNull()).alias("distinct_keys"),
    ).select(F.lit(label).alias("key_name"), "*", F.when(dense, PASS).otherwise(FAIL).alias("status"))


def distribution(
    df: DataFrame, column: str, target_pct: Mapping[str, float], tolerance: float, label: str
) -> DataFrame:
    """(measure, group_value, row_count, share_pct, target_pct, status) per target group."""
    targets = df.sparkSession.createDataFrame(
        [(g, float(p)) for g, p in target_pct.items()], "group_value string, target_pct double"
    )
    groups = _per_key(df, F.col(column).cast("string")).withColumnRenamed("_k0", "group_value")
    whole = F.sum("_n").over(Window.partitionBy())
    shares = groups.withColumn("_share", F.col("_n") * 100.0 / whole)
    found = F.coalesce("_share", F.lit(0.0))
    return targets.join(shares, "group_value", "left").select(
        F.lit(label).alias("measure"),
        "group_value",
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("row_count"),
        F.round(found.cast("decimal(28,6)"), 2).cast("double").alias("share_pct"),
        "target_pct",
        F.when(F.abs(found - F.col("target_pct")) <= tolerance, PASS).otherwise(FAIL).alias("status"),
    )


def key_coverage(parent: DataFrame, pk: str, child: DataFrame, fk: str, label: str) -> DataFrame:
    """Parents that no child refers to: a finding, not a failure."""
    used = child.select(F.col(fk).alias(pk)).distinct().withColumn("_used", F.lit(True))
    return parent.select(pk).join(used, pk, "left").agg(
        F.count("*").alias("parents"), _count(F.col("_used").isNull()).alias("unused")
    ).select(F.lit(label).alias("relation"), "*", verdict(F.col("unused"), FINDING).alias("status"))


def date_range(df: DataFrame, column: str, low: Column, high: Column, label: str) -> DataFrame:
    day = F.to_date(column)
    return df.agg(_count((day < low) | (day > high)).alias("out_of_range")).select(
        F.lit(label).alias("column_name"), "out_of_range"
    )


def spot_rows(df: DataFrame, key: str, expected: Mapping[object, Mapping[str, str]]) -> DataFrame:
    """Named rows against expected attributes: (key, attribute, expected, actual, status)."""
    wanted = [(str(k), a, v) for k, attrs in expected.items() for a, v in attrs.items()]
    want = df.sparkSession.createDataFrame(wanted, "key string, attribute string, expected string")
    names = sorted({a for _, a, _ in wanted})
    facts = (
        df.filter(F.col(key).cast("string").isin(*[str(k) for k in expected]))
        .select(F.col(key).cast("string").alias("key"), *[F.col(a).cast("string").alias(a) for a in names])
        .unpivot("key", names, "attribute", "actual")
    )
    same = F.col("expected").eqNullSafe(F.col("actual"))
    return want.join(facts, ["key", "attribute"], "left").select(
        "*", F.when(same, PASS).otherwise(FAIL).alias("status")
    )


def explained_negatives(
    snapshot: DataFrame, refunds: DataFrame, month: Column, trailing: int
) -> DataFrame:
    """Negative trailing revenue must come from a refund whose order left the window.

    ``snapshot``: customer_key, rolling_12mo_c. ``refunds``: customer_key, and
    the month indexes order_m and return_m. A refund explains the months from
    its own, or the first in which its order has left the window, to the last in
    which it lies in the window itself.
    """
    negatives = snapshot.filter("rolling_12mo_c < 0").select("customer_key", month.alias("m"))
    spans = refunds.select(
        "customer_key",
        F.greatest(F.col("return_m"), F.col("order_m") + trailing).alias("first_m"),
        (F.col("return_m") + trailing - 1).alias("last_m"),
    )
    explains = (
        interval_join(negatives, spans, "m", "first_m", "last_m", ["customer_key"], both_large=True)
        .select("customer_key", "m")
        .distinct()
        .withColumn("_ok", F.lit(True))
    )
    return negatives.join(explains, ["customer_key", "m"], "left").agg(
        F.count("*").alias("negative_rows"), _count(F.col("_ok").isNull()).alias("unexplained")
    )


def disagreements(left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Two derivations of the same rows, compared whole: one count per column,
    and the rows only one side has."""
    marked = left.withColumn("_l", F.lit(True)).alias("a").join(
        right.withColumn("_r", F.lit(True)).alias("b"), list(key), "full"
    )
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return marked.agg(
        F.count("*").alias("compared_rows"),
        _count(F.col("_r").isNull()).alias("only_first"),
        _count(F.col("_l").isNull()).alias("only_second"),
        *[_count(both & ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(c) for c in columns],
    )


def results(checks: DataFrame) -> DataFrame:
    """Roll check verdicts up per tier and over all. Any FAIL denies certification."""
    def n(status: str, severity: str | None = None) -> Column:
        hit = F.col("status") == status
        return F.count_if(hit if severity is None else hit & (F.col("severity") == severity))

    tiers = F.explode(F.array(F.col("tier"), F.lit("all")))
    return (
        checks.select(tiers.alias("tier"), "severity", "status")
        .groupBy("tier")
        .agg(
            F.count("*").alias("checks"),
            n(PASS).alias("passed"),
            n(FINDING).alias("findings"),
            n(FAIL, "BLOCKING").alias("blocking_failures"),
            n(FAIL, "ADVISORY").alias("advisory_failures"),
            F.when(n(FAIL) == 0, "CERTIFIED").otherwise("NOT CERTIFIED").alias("overall"),
        )
    )
