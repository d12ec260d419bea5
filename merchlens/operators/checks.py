"""Many checks in one pass over a table.

Rules over the rows of a table, and sums that its rows hand up to a coarser
grain, are compiled into one aggregate: every row is unfolded into one entry for
each grain it counts in and one for each rule it breaks, and all entries are
grouped together. Broken rules are rare, so a table is read once and little more
than its coarser grains is shuffled, whatever the number of rules.

A broken rule keeps the key of its row. Evidence for a check is the smallest of
its keys, chosen where the rows are, so no more than a few keys per check and
task are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from copy import copy
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlens.operators.quality import FAIL, FINDING, PASS
from merchlens.session import stage

EVIDENCE_KEYS = 5
VIOLATIONS = "check string, key string, n bigint"


@dataclass(frozen=True)
class Rule:
    """Rows for which ``broken`` is true count ``weight`` violations of a check; one that cannot be decided is not broken."""

    check: str
    broken: Column
    key: Column
    weight: Column | None = None


@dataclass(frozen=True)
class Grain:
    """Rows for which ``when`` is true are summed per ``keys``; ``least`` and ``most`` keep extremes."""

    name: str
    keys: Mapping[str, Column]
    sums: Mapping[str, Column] = field(default_factory=dict)
    least: Mapping[str, Column] = field(default_factory=dict)
    most: Mapping[str, Column] = field(default_factory=dict)
    when: Column | None = None


class RolledUp:
    """What one pass over a table gives: its coarser grains and the rules its rows break, stored once."""

    def __init__(self, rows: DataFrame, rules: Sequence[Rule], grains: Sequence[Grain], label: str):
        self.rules, self.grains = list(rules), {g.name: g for g in grains}
        fields = self._fields()
        entries = [self._entry(fields, g) for g in grains] + [self._broken(fields, r) for r in rules]
        inputs = [F.struct(*[c.cast("string" if k == "key" else self._kind(rows, k)).alias(k) for k, c in e[1].items()]) for e in entries]
        # Most entries of a row are empty; they are dropped after the array, in generated code.
        unfolded = rows.select(F.explode(F.array(*[F.when(w, s) for (w, _), s in zip(entries, inputs, strict=True)])).alias("e")).filter("e is not null")
        self.stored = stage(self._summed(unfolded.select("e.*")), label, lean=True)

    def _summed(self, entries: DataFrame) -> DataFrame:
        keys = ["grain", "check", "key", *self._named("keys")]
        return entries.groupBy(*keys).agg(
            F.sum("n").alias("n"),
            *[F.sum(c).alias(c) for c in self._named("sums")],
            *[F.min(c).alias(c) for c in self._named("least")],
            *[F.max(c).alias(c) for c in self._named("most")],
        )

    def also(self, rows: DataFrame, label: str) -> RolledUp:
        """This pass and one by the same rules and grains over further rows, as one."""
        both = copy(self)
        more = RolledUp(rows, self.rules, list(self.grains.values()), f"{label}-more")
        both.stored = stage(self._summed(self.stored.unionByName(more.stored)), label, lean=True)
        return both

    def _named(self, part: str) -> list[str]:
        return list(dict.fromkeys(c for g in self.grains.values() for c in getattr(g, part)))

    def _fields(self) -> list[str]:
        return ["grain", "check", "key", *self._named("keys"), "n", *self._named("sums"), *self._named("least"), *self._named("most")]

    def _kind(self, rows: DataFrame, name: str) -> str:
        """The type of an entry's column, which all entries share."""
        if name in ("grain", "check"):
            return "string"
        if name == "n" or name in self._named("sums"):
            return "bigint"
        for g in self.grains.values():
            for part in (g.keys, g.least, g.most):
                if name in part:
                    return rows.select(part[name].alias(name)).schema[0].dataType.simpleString()
        raise KeyError(name)

    @staticmethod
    def _entry(fields: Sequence[str], g: Grain) -> tuple[Column, dict[str, Column]]:
        told = {"grain": F.lit(g.name), "n": F.lit(1), **g.keys, **g.sums, **g.least, **g.most}
        return F.lit(True) if g.when is None else g.when, {f: told.get(f, F.lit(None)) for f in fields}

    @staticmethod
    def _broken(fields: Sequence[str], r: Rule) -> tuple[Column, dict[str, Column]]:
        told = {"check": F.lit(r.check), "key": r.key, "n": F.lit(1) if r.weight is None else r.weight}
        return r.broken, {f: told.get(f, F.lit(None)) for f in fields}

    def grain(self, name: str) -> DataFrame:
        """The rows of a coarser grain: its keys, ``n`` (rows summed), sums and extremes."""
        g = self.grains[name]
        return self.stored.filter(F.col("grain") == name).select(*g.keys, "n", *g.sums, *g.least, *g.most)

    def violations(self) -> DataFrame:
        """(check, key, n) of every broken rule, and one row without a key for every rule that was looked at."""
        spark = self.stored.sparkSession
        broken = self.stored.filter("check is not null").select("check", "key", "n")
        return broken.unionByName(looked_at(spark, [r.check for r in self.rules]))


def looked_at(spark: SparkSession, checks: Sequence[str]) -> DataFrame:
    """Rows that say that checks were made, without a violation."""
    return spark.createDataFrame([(c, None, 0) for c in dict.fromkeys(checks)], VIOLATIONS)


def smallest_keys(violations: DataFrame, most: int = EVIDENCE_KEYS) -> DataFrame:
    """(check, evidence): the smallest violating keys of each check, numbers before text.

    The rank is cut to ``most`` rows a check before the shuffle, so a check that every row breaks costs no more.
    """
    order = Window.partitionBy("check").orderBy(F.expr("try_cast(key AS BIGINT)").asc_nulls_last(), "key")
    few = (
        violations.filter("key is not null and n <> 0")
        .select("check", "key").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    )
    kept = F.array_sort(F.collect_list(F.struct("place", "key")))
    return few.groupBy("check").agg(F.array_join(F.transform(kept, lambda r: r["key"]), ", ").alias("evidence"))


def judged(checks: DataFrame, violations: DataFrame, told: DataFrame) -> DataFrame:
    """Every check with its violations, evidence and verdict.

    ``checks``: check_id, tier, severity, name, on_violation. ``violations``: (check, key, n), with a row for every
    check that was made. ``told``: (check, evidence, verdict) of checks that state their own. A check without any
    row in either was not made, and fails whatever its severity.
    """
    counts = violations.groupBy("check").agg(F.sum("n").alias("found"))
    stated = told.groupBy("check").agg(
        F.count_if(F.col("verdict") != PASS).alias("not_passed"),
        F.max(F.when(F.col("verdict") == FAIL, 2).when(F.col("verdict") == FINDING, 1).otherwise(0)).alias("worst"),
        F.array_join(F.array_sort(F.collect_list("evidence")), ", ").alias("said"),
    )
    rows = (
        checks.join(counts, F.col("check_id") == counts["check"], "left").drop("check")
        .join(smallest_keys(violations).withColumnRenamed("check", "of_keys"), F.col("check_id") == F.col("of_keys"), "left")
        .join(stated.withColumnRenamed("check", "of_told"), F.col("check_id") == F.col("of_told"), "left")
    )
    made = F.col("found").isNotNull() | F.col("worst").isNotNull()
    verdict = (
        F.when(~made, FAIL)
        .when(F.col("worst") == 2, FAIL)
        .when((F.col("worst") == 1), FINDING)
        .when(F.col("found") > 0, F.col("on_violation"))
        .otherwise(PASS)
    )
    return rows.select(
        "check_id", "tier", "severity", "name",
        F.when(made, F.coalesce("found", "not_passed")).otherwise(1).cast("bigint").alias("violations"),
        F.when(~made, "not made").otherwise(F.coalesce("evidence", "said", F.lit(""))).alias("evidence"),
        verdict.alias("status"),
    )


class NotCertified(Exception):
    """Checks that failed, with their evidence."""

    def __init__(self, failed: list):
        self.failed = failed
        super().__init__("; ".join(f"{r.check_id} {r.name}: {r.violations} ({r.evidence})" for r in failed))


def require_certified(checks: DataFrame) -> int:
    """Raise ``NotCertified`` if any check failed, advisory ones too; otherwise the number of findings."""
    # One row per check, of which there are as many as were written down.
    rows = checks.filter(F.col("status") != PASS).orderBy("check_id").collect()
    failed = [r for r in rows if r.status == FAIL]
    if failed:
        raise NotCertified(failed)
    return len(rows)
