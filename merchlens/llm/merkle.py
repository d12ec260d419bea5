"""A Merkle manifest of a dataset by time-forward processing.

Every row is a leaf, the leaves of a group in key order make a tree, and the
trees' tops in group order make one more. Nodes are labelled so that a parent
comes after its children: by the last leaf below them, then by level. A sweep
in label order keeps digests that are under way in a priority queue; a node
takes its children's digests from the queue's front and sends its own to its
parent's label. As the label follows the leaves, the queue holds two digests a
level at most. The reversed sweep takes each node's proof suffix (siblings from
there to the root) from the queue and sends longer ones to its children, until
the leaves have whole proofs.

The queue is external: sweeps run over blocks of 2**``bits`` neighbouring
leaves, each in its own task, and what leaves a block (one digest upward, one
suffix downward) is a row that Spark's sorted shuffle delivers to the block of
the next round. Rounds are as many as the number of leaves has digits to that
base; texts are read once, for the leaves' digests, and never shuffled.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.runs import runs
from merchlens.operators.ranking import with_rank
from merchlens.session import stage

BITS = 12
# Levels a label has room for; a tree has fewer.
_LEVELS = 64


def digest_of(*values: Column) -> Column:
    """The SHA-256 of values laid end to end, each `-` if null, else its UTF-8 length, a colon and itself."""
    parts = [
        F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")))
        for v in values
    ]
    return F.sha2(F.concat(*parts), 256)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _height(leaves: int, bits: int) -> int:
    """Levels that a block of a tree with so many leaves rises."""
    return min(bits, (leaves - 1).bit_length())


def rise(digests: Sequence[str], height: int) -> tuple[str, list[tuple[int, int, list[str]]]]:
    """The forward sweep over a block's leaves: its top, and (label, place, children) of every node in label order."""
    last = len(digests) - 1

    def label(level: int, place: int) -> int:
        return min(((place + 1) << level) - 1, last) * _LEVELS + level

    queue: list[tuple[int, int, str]] = []
    done = []
    top = digests[0]
    for at, leaf in enumerate(digests):
        if height:
            heapq.heappush(queue, (label(1, at >> 1), at, leaf))
        while queue and queue[0][0] // _LEVELS == at:
            now, child, first = heapq.heappop(queue)
            children = [first]
            while queue and queue[0][0] == now:
                children.append(heapq.heappop(queue)[2])
            level, place = now % _LEVELS, child >> 1
            top = _sha("".join(children))
            done.append((now, place, children))
            if level < height:
                heapq.heappush(queue, (label(level + 1, place >> 1), place, top))
    return top, done


def fall(leaves: int, height: int, done: list[tuple[int, int, list[str]]], suffix: str) -> list[str]:
    """The reversed sweep: every leaf's proof, given that of the block's top.

    A proof lists, from the leaf up, the sibling at each level with its side
    (``L`` or ``R``), or ``-`` where the node was alone, set apart by blanks.
    """
    if not height:
        return [suffix]
    proofs = [""] * leaves
    queue = [(-done[-1][0], suffix)]
    for now, place, children in reversed(done):
        label, above = heapq.heappop(queue)
        if label != -now:
            raise AssertionError("a suffix was sent to a node that does not exist")
        tail = f" {above}" if above else ""
        level = now % _LEVELS - 1
        for k in range(len(children)):
            below = (f"{'LR'[1 - k]}{children[1 - k]}" if len(children) == 2 else "-") + tail
            child = 2 * place + k
            if level:
                end = min(((child + 1) << level) - 1, leaves - 1)
                heapq.heappush(queue, (-(end * _LEVELS + level), below))
            else:
                proofs[child] = below
    return proofs


def _riser(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, ["tree", "block"]):
            n = block.column("n")[0].as_py()
            top, _ = rise(block.column("digest").to_pylist(), _height(n, bits))
            row = [[block.column("tree")[0].as_py()], [block.column("block")[0].as_py()], [-(-n >> bits)], [top]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["tree", "pos", "n", "digest"])

    return run


def _faller(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, ["tree", "block"]):
            # The message to the block comes before its leaves.
            suffix, subroot = block.column("suffix")[0].as_py(), block.column("subroot")[0].as_py()
            leaves = block.slice(1)
            digests = leaves.column("digest").to_pylist()
            height = _height(leaves.column("n")[0].as_py(), bits)
            _, done = rise(digests, height)
            out = leaves.drop_columns(["block", "suffix", "subroot"])
            out = out.append_column("suffix", pa.array(fall(len(digests), height, done, suffix), pa.string()))
            yield from out.append_column("subroot", pa.array([subroot] * len(digests), pa.string())).to_batches()

    return run


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _up(leaves: DataFrame, bits: int) -> list[DataFrame]:
    """Leaves (tree, pos, n, digest, ...), then the tops of their blocks, and so on up to one top a tree."""
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = levels[-1].select("tree", F.shiftright("pos", bits).alias("block"), "pos", "n", "digest")
        levels.append(stage(_by_block(blocks).mapInArrow(_riser(bits), "tree long, pos long, n long, digest string"), "merkle"))
        most = -(-most >> bits)
    return levels


def _down(levels: list[DataFrame], tops: DataFrame, bits: int) -> DataFrame:
    """The leaves with their proofs (``suffix``), given those of each tree's top: (tree, block, suffix, subroot)."""
    messages, rows = tops, None
    for level in reversed(levels):
        blocks = level.withColumn("block", F.shiftright("pos", bits)).unionByName(
            messages.withColumn("pos", F.lit(-1).cast("bigint")), allowMissingColumns=True
        )
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in level.schema.fields)
        rows = _by_block(blocks).mapInArrow(_faller(bits), f"{kinds}, suffix string, subroot string")
        messages = rows.select("tree", F.col("pos").alias("block"), "suffix", "subroot")
    return rows


def manifest(leaves: DataFrame, key: str, group: str, leaf: str = "leaf", bits: int = BITS) -> DataFrame:
    """Build the manifest of ``leaves``: every row with ``subroot``, ``root`` and ``proof`` added.

    ``leaf`` is the row's digest as hex text. The rows of a group ascend by
    ``key`` (nulls first); groups ascend by name (null first, by bytes). Every
    two neighbouring nodes of a level become one, a last one alone too, until one
    is left; the groups' tops likewise. A lone leaf is its own top and has an
    empty proof.

    Defined cases: rows that share a key are ordered by their leaf, and repeated
    rows stand next to each other as leaves of their own. A null group is a
    group. A group that holds most rows spans many blocks and tasks. An empty
    table gives none. Other columns pass through; their names may be anything
    but ``subroot``, ``root`` and ``proof`` in any case, which are replaced.
    """
    made = {"subroot", "root", "proof"}
    kept = [c for c in leaves.columns if c.lower() not in made]
    # The row stays inside one struct, so no name can clash with those made here.
    # Written first: a row's number then is the same whenever it is read, and no digest is made twice.
    stored = stage(
        leaves.select(
            F.struct(*kept).alias("row"),
            F.col(key).alias("key"),
            F.col(group).alias("group"),
            F.col(leaf).alias("digest"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "leaves",
    )
    ranked = with_rank(stored, F.col("group"), F.col("key"), F.col("digest"), F.col("number"), rank="at", total="all")
    groups = ranked.groupBy(F.col("group").alias("name")).agg(F.min("at").alias("tree"), F.count("*").alias("n"))
    placed = ranked.join(groups, F.col("group").eqNullSafe(F.col("name"))).select(
        "tree", (F.col("at") - F.col("tree")).alias("pos"), "n", "digest", "row"
    )
    levels = _up(placed, bits)
    tops = levels[-1].select("tree", "digest")
    roots = _up(
        with_rank(tops, F.col("tree"), rank="at", total="n").select(
            F.lit(0).cast("bigint").alias("tree"), (F.col("at") - 1).alias("pos"), "n", "digest", F.col("tree").alias("below")
        ),
        bits,
    )
    top = roots[-1].select("digest").first()
    root = top[0] if top else None
    start = leaves.sparkSession.range(1).select(
        F.col("id").alias("tree"), F.col("id").alias("block"), F.lit("").alias("suffix"), F.lit(None).cast("string").alias("subroot")
    )
    if root is None:
        start = start.limit(0)
    to_groups = _down(roots, start, bits).select(
        F.col("below").alias("tree"), F.lit(0).cast("bigint").alias("block"), "suffix", F.col("digest").alias("subroot")
    )
    out = _down(levels, stage(to_groups, "merkle"), bits)
    return out.select(
        *[F.col("row")[c].alias(c) for c in kept], "subroot", F.lit(root).cast("string").alias("root"), F.col("suffix").alias("proof")
    )


def siblings(proof: Column) -> Column:
    """The sibling digests of a proof from the leaf up, laid end to end."""
    return F.translate(proof, "LR- ", "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf's digest and its proof."""

    def step(at: Column, s: Column) -> Column:
        other = F.substr(s, F.lit(2))
        return F.sha2(F.when(s == "-", at).when(F.startswith(s, F.lit("L")), F.concat(other, at)).otherwise(F.concat(at, other)), 256)

    return F.when(proof == "", leaf).otherwise(F.aggregate(F.split(proof, " "), leaf, step))


def manifest_report(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """The manifest of ``documents`` by language, and the root that each leaf's proof folds to.

    Where 7 divides the CRC-32 of the id, the leaf that is folded is that of the row with
    one more in ``n_chars``; a null there stays. A null id is not altered.
    """
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [*values[:3], F.when(altered, F.col("n_chars") + 1).otherwise(F.col("n_chars")), values[4]]
    leaves = docs.select("doc_id", "lang", digest_of(*values).alias("leaf"), F.when(altered, digest_of(*changed)).alias("other"))
    found = manifest(leaves, "doc_id", "lang", bits=bits)
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
        folded(F.coalesce("other", "leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_digest(n_chars: str) -> str:
    parts = [
        f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v}::VARCHAR END"
        for v in ("doc_id", "source", "lang", n_chars, "text")
    ]
    return f"sha256({' || '.join(parts)})"


# The CRC-32 of the id's digits, bit by bit.
_SQL_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""


def _sql_steps(rows: str, tree: str) -> str:
    """Per row of ``rows`` the steps from its place to the top of ``tree``."""
    return f"""SELECT r.tree, r.pos, list(CASE WHEN t.digest IS NULL THEN '-' WHEN t.pos % 2 = 0 THEN 'L' || t.digest ELSE 'R' || t.digest END ORDER BY h.level) AS steps
  FROM {rows} r JOIN (SELECT DISTINCT tree, level FROM {tree} WHERE n > 1) h ON h.tree = r.tree
  LEFT JOIN {tree} t ON t.tree = r.tree AND t.level = h.level AND t.pos = xor(r.pos // (1::BIGINT << h.level), 1)
  GROUP BY r.tree, r.pos"""


SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_sql_digest("n_chars")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_SQL_CRC} % 7 = 0 THEN {_sql_digest("(n_chars + 1)")} ELSE {_sql_digest("n_chars")} END AS other
  FROM documents
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1
  GROUP BY tree, level, pos // 2, n
), subroots AS (
  SELECT 0 AS tree, tree - 1 AS pos, count(*) OVER () AS n, digest FROM nodes WHERE n = 1
), tops AS (
  SELECT tree, 0 AS level, pos, n, digest FROM subroots
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1
  GROUP BY tree, level, pos // 2, n
), low AS ({_sql_steps("placed", "nodes")}
), high AS ({_sql_steps("subroots", "tops")}
), whole AS (
  SELECT p.doc_id, p.leaf, p.other, s.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
    list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps
  FROM placed p JOIN subroots s ON s.pos = p.tree - 1
  LEFT JOIN low ON low.tree = p.tree AND low.pos = p.pos LEFT JOIN high ON high.pos = p.tree - 1
), done AS (
  SELECT *, list_reduce(list_prepend(other, steps),
    lambda a, s: sha256(CASE WHEN s = '-' THEN a WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
  FROM whole
)
SELECT doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(list_filter(steps, lambda s: s <> '-'), lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM done
"""
