"""Line deduplication across documents, as DataFrame operations only.

Lines are exploded with their position, their normalised form is hashed, the
distinct documents of each hash are counted, lines over the threshold go, and
the rest is put together again by position. Only (document, position, hash)
rows are shuffled for the counting; the texts move once, for the last join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.session import stage

# The characters stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _UPPER.lower())


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Drop lines that many documents share, except in the last document that holds them.

    A line whose key has at least ``min_chars`` code points and is found in at
    least ``min_docs`` distinct ids goes from every document but the one with
    the largest id. Returns every row of ``docs`` with ``text_col`` replaced by
    the kept lines and ``n_lines`` (before) and ``n_dropped`` added.

    Defined cases: a null or empty text is one empty line and becomes the empty
    text. Rows that share an id are one document for the count, and each keeps
    its own lines. Rows without an id are together one document that comes
    before all others. Other columns pass through; input columns named
    ``n_lines`` or ``n_dropped`` are replaced. An empty table gives none.
    """
    # The input's columns stay inside one struct, so no name can clash with those made here.
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
    )
    lines = rows.select(
        "id", "text_hash", F.posexplode(F.transform(_lines(F.col(f"row.{text_col}")), line_key)).alias("pos", "key")
    ).filter(F.char_length("key") >= min_chars)
    # Two hashes of 64 bits: keys are told apart at any corpus size.
    hashed = lines.select(
        "id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2")
    )
    # Written out, so that the join below reads two shuffles and a hot line's rows can be split.
    repeated = stage(
        hashed.groupBy("h1", "h2")
        .agg(
            (F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("n_docs"),
            F.max("id").alias("last_id"),
        )
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "last_id"),
        "repeated-lines",
    )
    dropped = (
        hashed.join(repeated, ["h1", "h2"])
        .filter(~F.col("id").eqNullSafe(F.col("last_id")))
        .groupBy(F.col("id").alias("d_id"), F.col("text_hash").alias("d_hash"))
        .agg(F.collect_set("pos").alias("gone"))
    )
    joined = rows.join(
        dropped, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("text_hash") == F.col("d_hash")), "left"
    ).select("row", "gone", _lines(F.col(f"row.{text_col}")).alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.coalesce(F.col(f"row.{text_col}"), F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n")
    )
    made = {"n_lines", "n_dropped"}
    passed = [
        text.alias(text_col) if name == text_col else F.col("row")[name].alias(name)
        for name in docs.columns
        if name.lower() not in made
    ]
    return joined.select(
        *passed,
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """One row per document: line counts and the SHA-256 of the kept text."""
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.last_id AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
