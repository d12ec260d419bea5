"""Global ranks and tiles without a one-task window.

``row_number`` and ``ntile`` over a whole table pull it into one task. Here the
table is range-partitioned by the wanted order, sorted inside each partition and
stored with the row's position. The count of each partition (one row per
partition) then turns positions into ranks. The order must end in
a unique key, which also lets range partitioning split equal values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.session import stage

# Position layout of monotonically_increasing_id: partition above, row below.
_ROW_BITS = 33
_BROADCAST_GROUPS = 100_000


def with_rank(df: DataFrame, *order: Column, rank: str = "rank", total: str = "n") -> DataFrame:
    """Add the 1-based ``rank`` in ``order`` and the row count ``total``."""
    # Without a fixed number, adaptive execution may merge neighbouring ranges of
    # a small table; merged ranges keep their order.
    stored = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "rank",
    ).withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    counts = stored.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per partition, so these windows and the broadcast are bounded.
    offsets = counts.select(
        "_part",
        (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias(total),
    )
    row = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + row)
        .drop("_part", "_pos", "_before")
    )


def tile_of(rank: Column, n: Column, k: int) -> Column:
    """The tile 1..k of a rank, sized as NTILE(k) sizes them."""
    small = F.floor(n / k).cast("bigint")
    extra = n % k
    in_big = extra * (small + 1)
    rest = extra + F.ceil((rank - in_big) / F.greatest(small, F.lit(1)))
    return F.when(rank <= in_big, F.ceil(rank / (small + 1))).otherwise(rest).cast("bigint")


def with_tile(df: DataFrame, k: int, *order: Column, tile: str) -> DataFrame:
    ranked = with_rank(df, *order, rank="_rank", total="_n")
    return ranked.withColumn(tile, tile_of(F.col("_rank"), F.col("_n"), k)).drop("_rank", "_n")


def with_tile_of_few(df: DataFrame, k: int, value: str, *ties: Column, tile: str) -> DataFrame:
    """Like ``with_tile`` in the order of ``value``, which has few distinct values (days).

    Counts per value tell the tile of every row of most values; only the rows of
    the at most k - 1 values on which a tile ends are put in order by ``ties``.
    ``df`` is read twice.
    """
    counts = df.groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_value_rows"))
    # One row per distinct value, so these windows and the broadcast are bounded.
    before = F.sum("_value_rows").over(Window.orderBy(F.col("_v").asc_nulls_first())) - F.col("_value_rows")
    marks = counts.select("_v", "_value_rows", before.alias("_value_start"), F.sum("_value_rows").over(Window.partitionBy()).alias("_value_n"))
    marks = marks.select(
        "_v",
        "_value_start",
        "_value_n",
        tile_of(F.col("_value_start") + 1, F.col("_value_n"), k).alias("_low"),
        tile_of(F.col("_value_start") + F.col("_value_rows"), F.col("_value_n"), k).alias("_high"),
    )
    placed = df.join(F.broadcast(marks), F.col(value).eqNullSafe(F.col("_v")))
    whole = placed.filter("_low = _high").select(*df.columns, F.col("_low").alias(tile))
    cut = with_group_rank(placed.filter("_low < _high"), ["_v"], *ties, rank="_in_value", total="_value_size")
    rank = F.col("_value_start") + F.col("_in_value")
    return whole.unionByName(cut.select(*df.columns, tile_of(rank, F.col("_value_n"), k).alias(tile)))


def with_group_rank(df: DataFrame, groups: Sequence[str], *order: Column, rank: str = "rank", total: str = "n") -> DataFrame:
    """Like ``with_rank`` inside each group, for a large group as well as a small one.

    One order over all groups is cut up by the first rank of each group, so a
    group may span many partitions. The groups' sizes are broadcast if they are
    few (bands, segments, strata) and joined by a shuffle otherwise.
    """
    ranked = with_rank(df, *[F.col(g) for g in groups], *order, rank="_rank", total="_all").drop("_all")
    sizes = ranked.groupBy(*[F.col(g).alias(f"_g_{g}") for g in groups]).agg(
        F.count("*").alias(total), F.min("_rank").alias("_first")
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]
    few = sizes.count() <= _BROADCAST_GROUPS
    return (
        ranked.join(F.broadcast(sizes) if few else sizes, same)
        .withColumn(rank, F.col("_rank") - F.col("_first") + 1)
        .drop("_rank", "_first", *[f"_g_{g}" for g in groups])
    )
