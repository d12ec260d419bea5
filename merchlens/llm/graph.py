"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.session import stage, unstage


def _large_star(links: DataFrame) -> DataFrame:
    """Every vertex hands its larger neighbours to the smallest vertex it knows."""
    both = links.union(links.select("b", "a")).toDF("v", "u")
    least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("low"))
    return both.filter("u > v").join(least, "v").select(F.col("u").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every vertex hands its smaller neighbours, and itself, to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    handed = links.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
    return handed.filter("a > b")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """The vertices of ``links`` with the smallest vertex they reach: (vertex, component).

    Links have no direction; repeated links, links to itself and links with a
    null do nothing (a vertex that has no other link gets no row). Each round
    writes its links to the shared scratch folder, so a lost executor costs a
    read. Rounds end when every vertex but a component's smallest has one link,
    to that smallest. Hot vertices are reduced by partial minima and skew joins.
    """
    now = stage(
        links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct(),
        "links",
    )
    state = _summary(now)
    while state is not None:
        before, now = now, stage(_small_star(_large_star(now).distinct()).distinct(), "links")
        unstage(before)
        after = _summary(now)
        if after == state:
            break
        state = after
    least = now.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    return least.union(now.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct())


def _summary(links: DataFrame) -> tuple | None:
    """What tells one set of links from the next; None without links."""
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()
    return tuple(row) if row[0] else None
