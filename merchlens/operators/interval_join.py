"""Join of events with the windows that hold them, as an equi join.

A window is cut into the fewest aligned blocks whose lengths are powers of two:
at most two of each length, so about twice the logarithm of its length, however
long it is. An event lies in one aligned block of each length. Events and
windows then meet by (length, block) and by the equal columns, once per pair and
without a test afterwards, so Spark shuffles, splits hot keys or broadcasts a
small side as for any equi join. Only lengths that some window uses are made
for events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.session import lean_jobs


def _number(df: DataFrame, column: str) -> Column:
    return F.unix_date(column) if isinstance(df.schema[column].dataType, T.DateType) else F.col(column).cast("bigint")


def blocks_of(first: Column, last: Column) -> Column:
    """The aligned blocks [block * 2**level, (block + 1) * 2**level) that make up first..last: array of (level, block)."""
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    one = F.lit(1).cast("bigint")

    def step(at: Column, level: Column) -> Column:
        a, b = at["a"], at["b"]
        low = (a < b) & (a.bitwiseAND(one) == 1)
        after = F.when(low, a + 1).otherwise(a)
        high = (after < b) & (b.bitwiseAND(one) == 1)
        before = F.when(high, b - 1).otherwise(b)

        def block(taken: Column, place: Column) -> Column:
            return F.when(taken, F.array(F.struct(level.alias("level"), place.alias("block")))).otherwise(none)

        return F.struct(
            F.shiftright(after, 1).alias("a"), F.shiftright(before, 1).alias("b"), F.concat(at["out"], block(low, a), block(high, before)).alias("out")
        )

    # So many levels that the two ends have met.
    levels = F.sequence(F.lit(0), F.ceil(F.log2((last - first + 1).cast("double"))).cast("int") + 1)
    start = F.struct(first.cast("bigint").alias("a"), (last + 1).cast("bigint").alias("b"), none.alias("out"))
    return F.when(last >= first, F.aggregate(levels, start, step, lambda at: at["out"])).otherwise(none)


def interval_join(
    events: DataFrame, windows: DataFrame, at: str, start: str, end: str, on: Sequence[str] = (), both_large: bool = False
) -> DataFrame:
    """Every pair of an event and a window with ``start`` <= ``at`` <= ``end`` that agree in the columns ``on``.

    ``at``, ``start`` and ``end`` are dates or whole numbers. All columns of both sides are returned, ``on`` once; others
    must differ in name. Events or windows with a NULL in these columns, and windows that end before they start, meet
    nothing. Repeated rows meet as often as they are repeated.

    Unfolding and what was unfolded before it hide from Spark how many rows a side has, and a side it thinks small goes
    through the driver. ``both_large`` says that neither is small, so both are shuffled.
    """
    clash = {c.lower() for c in events.columns} & {c.lower() for c in windows.columns if c not in on}
    if clash:
        raise ValueError(f"both sides have {', '.join(sorted(clash))}")
    cut = windows.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn(
        "_w", F.explode(blocks_of(_number(windows, start), _number(windows, end)))
    )
    cut = cut.select("*", F.col("_w.level").alias("_level"), F.col("_w.block").alias("_block")).drop("_w")
    # A few dozen at most: one for each power of two up to the longest window.
    with lean_jobs(windows.sparkSession):
        levels = sorted(r[0] for r in cut.select("_level").distinct().collect())
    if not levels:
        levels = [0]
    place = _number(events, at)
    own = F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright(place, k).alias("_block")) for k in levels])
    unfolded = events.filter(F.col(at).isNotNull()).select("*", F.inline(own))
    if both_large:
        unfolded = unfolded.hint("merge")
    return unfolded.join(cut, [*on, "_level", "_block"]).drop("_level", "_block")
