"""Running totals over a global order, without a one-task window.

Rows with one value are one row before they are put in order, so ties need no
rule and a value that most rows share costs no more than any other. Values are
range-partitioned; each partition's sums (one row per partition and group) turn
into what lies before it, and a window inside the partition adds the rest.

What holds for ranks follows from this: rows of one value take the ranks from
``before_n`` + 1 to ``before_n`` + ``n``, whichever of them comes first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.session import stage

# Position layout of monotonically_increasing_id: partition above, row below.
_ROW_BITS = 33
# Sums of partitions are broadcast if they are so many or fewer.
_BROADCAST_SUMS = 100_000


def running_by_value(df: DataFrame, groups: Sequence[str], value: str, descending: bool = False) -> DataFrame:
    """One row per group and value of a whole-number column: how many rows have it and what lies before it.

    groups, ``value``, ``n``, ``before_n`` (rows of lesser value, or of greater with ``descending``), ``before_sum``
    (their sum), ``total_n`` and ``total_sum`` of the group. NULL values are left out.
    """
    per = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("n"))
    order = [*[F.col(g) for g in groups], F.desc(value) if descending else F.col(value)]
    stored = stage(
        per.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pos", F.monotonically_increasing_id()), "running"
    ).withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    amount = F.col(value) * F.col("n")
    sums = stage(stored.groupBy("_part", *groups).agg(F.sum("n").alias("_n"), F.sum(amount).alias("_s")), "running-parts")
    # One row per partition and group in it: as many as partitions and groups together.
    earlier = Window.partitionBy(*groups).orderBy("_part")
    whole = Window.partitionBy(*groups)
    offsets = sums.select(
        F.col("_part").alias("_p"),
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        (F.sum("_n").over(earlier) - F.col("_n")).alias("_n0"),
        (F.sum("_s").over(earlier) - F.col("_s")).alias("_s0"),
        F.sum("_n").over(whole).alias("total_n"),
        F.sum("_s").over(whole).alias("total_sum"),
    )
    small = sums.count() <= _BROADCAST_SUMS
    same = [F.col("_part") == F.col("_p")] + [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    inside = Window.partitionBy("_part", *groups).orderBy("_pos")
    return (
        stored.withColumns({"_n1": F.sum("n").over(inside) - F.col("n"), "_s1": F.sum(amount).over(inside) - amount})
        .join(F.broadcast(offsets) if small else offsets, same)
        .select(
            *groups, value, "n", (F.col("_n0") + F.col("_n1")).alias("before_n"), (F.col("_s0") + F.col("_s1")).alias("before_sum"),
            "total_n", "total_sum",
        )
    )


def rows_between(first: Column, last: Column) -> Column:
    """Of a value's rows, how many have ranks after ``first`` and up to ``last``."""
    start, stop = F.col("before_n"), F.col("before_n") + F.col("n")
    return F.greatest(F.least(stop, last) - F.greatest(start, first), F.lit(0))
