"""Exact quantiles by selection: no row is sorted and none is shuffled.

A quantile is the value at one or two positions of the ordered values. The
range of values is cut into bins of equal width, rows are counted per bin, and
only bins that hold a wanted position are cut again, until such a bin holds one
value or few rows. A round is one aggregate whose groups are bins, so it
shuffles some thousand rows however many values there are; a bin is never wider
than a part of the one before, so rounds are few, and two will do for values
that are spread out. All measures and groups are refined together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.session import stage, unstage

BINS = 4096
# A bin with so many rows or fewer is not cut again; its values are put in order as an array.
FEW_ROWS = 2048
# Bins that hold a wanted position are broadcast if there are so many or fewer; there are about
# two for each group and wanted quantile.
_BROADCAST_BINS = 50_000


def grouped_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    values: dict[str, Column],
    wanted: dict[str, tuple[str, float]],
) -> DataFrame:
    """Exact interpolated quantiles of several measures per group.

    ``values`` names the measures, ``wanted`` maps each output column to
    ``(measure, probability)``. ``df`` is read once for each round and twice
    besides, so it should be a stored table. NULL values are left out, and a
    group with no value of any measure gets no row.
    """
    measure = F.explode(F.array(*[F.struct(F.lit(m).alias("_m"), c.cast("double").alias("_v")) for m, c in values.items()]))
    named = {g: f"_g{i}" for i, g in enumerate(groups)}
    long = (
        df.select(*[F.col(g).alias(n) for g, n in named.items()], measure.alias("_mv"))
        .select(*named.values(), "_mv._m", "_mv._v")
        .filter(F.col("_v").isNotNull())
    )
    cell = ["_m", *named.values()]
    spots = F.array(*[F.struct(F.lit(o).alias("out"), F.lit(m).alias("of"), F.lit(float(p)).alias("p")) for o, (m, p) in wanted.items()])
    sizes = long.groupBy(*cell).agg(F.count("*").alias("rows"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    asked = sizes.withColumn("s", F.explode(F.filter(spots, lambda s: s["of"] == F.col("_m")))).withColumn("spot", (F.col("rows") - 1) * F.col("s.p"))
    # Each quantile lies at its position, or between two.
    goal = stage(
        asked.select(
            *cell, "s.out", (F.col("spot") - F.floor("spot")).alias("part"), F.explode(F.array(F.floor("spot"), F.ceil("spot"))).alias("at"),
            F.floor("spot").alias("first"), "low", "high", "rows", F.lit(0).cast("bigint").alias("below"),
        ),
        "quantiles",
    )
    while True:
        wide = goal.filter((F.col("low") < F.col("high")) & (F.col("rows") > FEW_ROWS))
        ranges = wide.select(*cell, "low", "high", "below").distinct()
        count = ranges.count()
        if not count:
            break
        before, goal = goal, stage(_refined(long, goal, ranges, cell, count), "quantiles")
        unstage(before)
    return _read_off(long, goal, cell, named, list(wanted))


def _inside(long: DataFrame, ranges: DataFrame, cell: Sequence[str], count: int) -> DataFrame:
    """Rows whose value lies in one of the ranges of their cell; ranges of a cell do not overlap."""
    side = ranges.select(*[F.col(c).alias(f"_r{c}") for c in cell], *[c for c in ranges.columns if c not in cell])
    same = [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in cell] + [F.col("_v").between(F.col("low"), F.col("high"))]
    return long.join(F.broadcast(side) if count <= _BROADCAST_BINS else side, same).drop(*[f"_r{c}" for c in cell])


def _refined(long: DataFrame, goal: DataFrame, ranges: DataFrame, cell: list[str], count: int) -> DataFrame:
    # Halves, so that the width of the widest range is a number; both steps keep the order of values.
    share = (F.col("_v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
    bins = (
        _inside(long, ranges, cell, count)
        .groupBy(*cell, "low", "high", "below", F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin"))
        .agg(F.count("*").alias("n"), F.min("_v").alias("bin_low"), F.max("_v").alias("bin_high"))
    )
    # As many rows as a range has bins.
    in_range = Window.partitionBy(*cell, "low", "high").orderBy("bin")
    bins = bins.withColumn("bin_below", F.col("below") + F.sum("n").over(in_range) - F.col("n")).drop("below", "bin")
    keys = [*cell, "low", "high"]
    side = bins.select(*[F.col(c).alias(f"_b{c}") for c in keys], "n", "bin_low", "bin_high", "bin_below")
    held = [F.col(c).eqNullSafe(F.col(f"_b{c}")) for c in keys] + [
        (F.col("at") >= F.col("bin_below")) & (F.col("at") < F.col("bin_below") + F.col("n"))
    ]
    found = goal.join(side, held, "left")
    return found.select(
        *cell, "out", "part", "at", "first",
        F.coalesce("bin_low", "low").alias("low"), F.coalesce("bin_high", "high").alias("high"),
        F.coalesce("n", "rows").alias("rows"), F.coalesce("bin_below", "below").alias("below"),
    )


def _read_off(long: DataFrame, goal: DataFrame, cell: list[str], named: dict[str, str], outs: list[str]) -> DataFrame:
    # A range of one value is its own answer; others hold few rows, so their values fit an array.
    ranges = goal.filter("low < high").select(*cell, "low", "high").distinct()
    few = _inside(long, ranges, cell, ranges.count()).groupBy(*cell, "low", "high").agg(F.sort_array(F.collect_list("_v")).alias("vs"))
    keys = [*cell, "low", "high"]
    side = few.select(*[F.col(c).alias(f"_b{c}") for c in keys], "vs")
    read = goal.join(side, [F.col(c).eqNullSafe(F.col(f"_b{c}")) for c in keys], "left").withColumn(
        "v", F.coalesce(F.get("vs", (F.col("at") - F.col("below")).cast("int")), "low")
    )

    def quantile(out: str) -> Column:
        mine = F.col("out") == out
        low = F.max(F.when(mine & (F.col("at") == F.col("first")), F.col("v")))
        high = F.max(F.when(mine, F.col("v")))
        return (low + (high - low) * F.max(F.when(mine, F.col("part")))).alias(out)

    back = [F.col(n).alias(g) for g, n in named.items()]
    return read.groupBy(*named.values()).agg(*[quantile(o) for o in outs]).select(*back, *outs)
