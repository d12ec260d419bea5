"""Mixing sources to target weights over a tree such as domain, language, source.

The budget goes down the tree. Children share their parent's budget by weight;
a child whose documents cannot fill its share takes what they can, and the rest
goes to its siblings by weight. As a parent's capacity is that of all its
leaves, a shortage reaches the parent's own siblings only when all below the
parent are full. A leaf's budget is filled from its documents in a seeded order
that is new for every epoch: whole epochs first, then the longest prefix of the
next one that fits.

The order inside a leaf is by a hash, so the end of the prefix is found from
token sums of hash ranges, then of ranges inside the range where the budget
ends; no leaf is ever sorted whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.session import stage, together

# Hexadecimal digits of the hash that make a range; two rounds of ranges.
_DIGITS = 3
# So many leaves (about 100 bytes each) are broadcast at most; more are joined by a shuffle.
_BROADCAST_LEAVES = 50_000

# The tree of the registered query and the pipeline.
LEVELS = ("domain", "lang", "source")
WEIGHTS: dict[str, dict[str, float]] = {
    "domain": {"crawl": 0.45, "curated": 0.35, "reference": 0.2},
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    "source": {},
}


def domain_of(source: Column) -> Column:
    """The domain of a source: src0 is a crawl, src1 to src9 are curated, all others reference."""
    return F.when(source == "src0", "crawl").when(source.rlike("^src[1-9]$"), "curated").otherwise("reference")


def token_count(text: Column) -> Column:
    """Words of a text: runs without ASCII blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _weight(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    out = F.lit(1.0)
    for value, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(float(weight))).otherwise(out)
    return out


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], budget: Column, max_epochs: int
) -> DataFrame:
    """Add ``leaf_budget`` (whole tokens) to leaves with their ``leaf_tokens``.

    One row per leaf of the tree; windows hold the children of one node.
    """
    now = leaves.withColumn("_capacity", (F.col("leaf_tokens") * max_epochs).cast("double")).withColumn("_given", budget.cast("double"))
    for depth, level in enumerate(levels):
        above = list(levels[:depth])
        node = [*above, level]
        children = now.groupBy(*node).agg(F.sum("_capacity").alias("_cap"), F.first("_given").alias("_all")).withColumn(
            "_w", _weight(level, weights)
        )
        ratio = F.col("_cap") / F.nullif(F.col("_w"), F.lit(0.0))
        order = Window.partitionBy(*above).orderBy(F.col("_ratio").asc_nulls_last(), F.col(level).asc_nulls_first())
        ranked = (
            children.withColumn("_ratio", ratio)
            .withColumn("_full_before", F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("_w_left", F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        )
        # Full if, were it and all before it full, the others' shares would not be smaller.
        ranked = ranked.withColumn(
            "_full", F.coalesce(F.col("_ratio") * F.col("_w_left") + F.col("_full_before") <= F.col("_all"), F.lit(False))
        )
        whole = Window.partitionBy(*above)
        rest = F.col("_all") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(whole), F.lit(0.0))
        open_w = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(whole)
        share = F.when(F.col("_full"), F.col("_cap")).otherwise(F.coalesce(rest * F.col("_w") / F.nullif(open_w, F.lit(0.0)), F.lit(0.0)))
        given = ranked.select(*[F.col(c).alias(f"_n_{c}") for c in node], share.alias("_share"))
        same = [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in node]
        now = now.join(given, same).withColumn("_given", F.col("_share")).drop("_share", *[f"_n_{c}" for c in node])
    # The sixteenth part of a token makes up for rounding of the shares.
    budget_out = F.least(F.floor(F.col("_given") + 1 / 16), F.col("_capacity").cast("bigint")).cast("bigint")
    return now.withColumn("leaf_budget", budget_out).drop("_capacity", "_given")


def _end_of_prefix(ordered: DataFrame, leaf: Sequence[str]) -> DataFrame:
    """Per leaf the last hash whose documents still fit: (leaf, cut); leaves where none fits are missing.

    ``ordered`` has the leaf, ``hash``, ``tokens`` and the leaf's ``rest``.
    """
    open_rows = ordered.withColumn("_before", F.lit(0).cast("bigint"))
    found = []
    for round_ in range(2):
        piece = F.substring("hash", 1 + round_ * _DIGITS, _DIGITS)
        rows = open_rows.withColumn("_range", piece)
        sums = rows.groupBy(*leaf, "_range").agg(
            F.sum("tokens").alias("_t"), F.max("hash").alias("_last"), F.first("rest").alias("rest"), F.first("_before").alias("_b")
        )
        # At most 16 ** 3 ranges per leaf.
        order = Window.partitionBy(*leaf).orderBy("_range")
        summed = stage(sums.withColumn("_end", F.col("_b") + F.sum("_t").over(order)), "ranges")
        found.append(summed.filter("_end <= rest").select(*leaf, F.col("_last").alias("hash")))
        broken = summed.filter("_end > rest and _end - _t <= rest").select(
            *[F.col(c).alias(f"_n_{c}") for c in leaf], F.col("_range").alias("_r"), (F.col("_end") - F.col("_t")).alias("_from")
        )
        same = [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in leaf] + [F.col("_range") == F.col("_r")]
        open_rows = (
            rows.join(broken, same).withColumn("_before", F.col("_from")).drop("_range", "_r", "_from", *[f"_n_{c}" for c in leaf])
        )
    # What is left is about one in 16 ** 6 of a leaf; equal hashes stay or go together.
    alike = open_rows.groupBy(*leaf, "hash").agg(
        F.sum("tokens").alias("_t"), F.first("rest").alias("rest"), F.first("_before").alias("_b")
    )
    end = F.col("_b") + F.sum("_t").over(Window.partitionBy(*leaf).orderBy("hash"))
    found.append(alike.withColumn("_end", end).filter("_end <= rest").select(*leaf, "hash"))
    return found[0].unionByName(found[1]).unionByName(found[2]).groupBy(*leaf).agg(F.max("hash").alias("cut"))


def mix(
    docs: DataFrame,
    levels: Sequence[str] = LEVELS,
    weights: Mapping[str, Mapping[str, float]] = WEIGHTS,
    share: float = 1.0,
    max_epochs: int = 2,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Choose documents so that tokens follow the weights of the tree.

    ``levels`` are columns of ``docs`` from the top down; ``weights`` gives a
    level's values their weight among siblings (1 if not listed). The budget is
    ``share`` of all tokens. Returns the columns of ``docs`` with ``tokens``
    and ``epoch``, one row for each time a document is taken.

    Defined cases: a null level value is a node of its own with weight 1; a null
    or empty text has no tokens and is taken once if nothing else decides; rows
    that share an id stay or go together, as do rows without an id that have the
    same text; columns named ``tokens`` or ``epoch`` are replaced. An empty
    table gives none.
    """
    made = ("tokens", "epoch")
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("-"), F.coalesce(F.col(text_col), F.lit(""))))
    rows = docs.select(
        F.struct(*[c for c in docs.columns if c.lower() not in made]).alias("row"),
        *[F.col(c).cast("string").alias(f"l_{c}") for c in levels],
        token_count(F.col(text_col)).alias("tokens"),
        F.md5(name).alias("name"),
    )
    leaf = [f"l_{c}" for c in levels]
    named = {f"l_{k}": v for k, v in weights.items()}
    counted = stage(together(rows.select(*leaf, "tokens", "name")), "mix-rows")
    leaves = counted.groupBy(*leaf).agg(F.sum("tokens").alias("leaf_tokens"))
    total = leaves.agg(F.floor(F.sum("leaf_tokens") * share)).scalar()
    budgets = leaf_budgets(leaves.withColumn("_total", total), leaf, named, F.col("_total"), max_epochs).drop("_total")
    empty = F.col("leaf_tokens") == 0
    plan = stage(
        budgets.withColumn("full", F.when(empty, 0).otherwise(F.expr("leaf_budget div leaf_tokens")).cast("int")).withColumn(
            "rest", F.col("leaf_budget") - F.col("full") * F.col("leaf_tokens")
        ),
        "mix-leaves",
    )
    few = plan.count() <= _BROADCAST_LEAVES

    def beside(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        right = right.select(*[F.col(c).alias(f"r_{c}") for c in leaf], *[c for c in right.columns if c not in leaf])
        same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in leaf]
        return left.join(F.broadcast(right) if few else right, same, how).drop(*[f"r_{c}" for c in leaf])

    place = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("full").cast("string"), F.col("name")))
    ordered = beside(counted, plan.select(*leaf, "full", "rest")).withColumn("hash", place)
    cuts = _end_of_prefix(ordered.select(*leaf, "hash", "tokens", "rest"), leaf)
    # A leaf that is full for the last allowed epoch has nothing left to take from the next.
    ends = stage(beside(plan.select(*leaf, "full"), cuts, "left"), "mix-ends")
    chosen = beside(rows, ends).withColumn("hash", place)
    partly = (F.col("hash") <= F.col("cut")) & (F.col("full") < max_epochs)
    times = F.col("full") + F.coalesce(partly, F.lit(False)).cast("int")
    taken = chosen.withColumn("times", times).filter("times > 0")
    return taken.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1))).select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in made], *made
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Which documents are taken, in which epoch, for the fixed tree."""
    placed = docs.withColumn("domain", domain_of(F.col("source")))
    return mix(placed).select("doc_id", "domain", "lang", "source", "tokens", "epoch")
