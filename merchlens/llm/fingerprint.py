"""Threshold-scaled document fingerprints, as DataFrame operations only.

Every five-word shingle is hashed to 64 bits, and all hashes below a fixed
fraction of the hash range are kept. Whether a hash is kept depends on the hash
alone, so sketches of any two texts can be compared and merged by set
operations, however unequal the texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.operators.ranking import with_rank

WORDS = 5
FRACTION = 1 / 4


def _limit(fraction: float) -> int:
    """The signed 64-bit number below which ``fraction`` of all hashes lie."""
    return -(1 << 63) + int(fraction * (1 << 64)) if fraction < 1 else (1 << 63) - 1


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words (runs without ASCII blanks) of a text, in order."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", -1)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def sketch(hashes: Column, words: int = WORDS, fraction: float = FRACTION) -> Column:
    """The sketch of a text from a column of its word hashes.

    ``hashes`` should be a plain column, as it is read once per shingle. A text
    with fewer words than a shingle is one shingle. If no hash lies below the
    threshold, the smallest one is kept, so only a text without words has an
    empty sketch.
    """
    whole = F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
    shingles = F.when(
        F.size(hashes) >= words,
        F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - (words - 1), F.lit(0))),
            lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, words)]),
        ),
    ).otherwise(whole)
    # The smallest hash stands first; after it come those below the threshold.
    low = F.filter(shingles, lambda h: h < F.lit(_limit(fraction)))
    return F.array_sort(
        F.array_distinct(F.when(F.size(low) > 0, low).when(F.size(shingles) > 0, F.array(F.array_min(shingles))).otherwise(low))
    )


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts together: all hashes below the threshold, or else the smallest."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda h: h < F.lit(_limit(fraction)))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two sketches; two empty ones are alike, one empty one is like none."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds; 1 for an empty ``a``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1))
    )


def too_short(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Whether two unequal sketches cannot tell likeness or containment, as a side has only the smallest hash.

    That hash lies above the threshold, so a sketch with hashes below it never
    holds it, even if its text holds all of the other.
    """
    # Sketches are in ascending order.
    only = [F.coalesce(F.get(s, F.lit(0)) >= F.lit(_limit(fraction)), F.lit(False)) for s in (a, b)]
    return (F.size(a) > 0) & (F.size(b) > 0) & (only[0] | only[1]) & (a != b)


def as_text(s: Column) -> Column:
    """A sketch as 16 hexadecimal digits per kept hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "sketch") -> DataFrame:
    """Add the sketch of ``text_col`` as an array of hashes; a null text counts as empty.

    Every row is kept, whatever its other columns; a column named ``out`` is replaced.
    """
    hashed = docs.select(F.struct("*").alias("row"), word_hashes(F.col(text_col)).alias("hashes"))
    return hashed.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c.lower() != out.lower()], sketch(F.col("hashes")).alias(out)
    )


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """Two hashes that stand for (id, text) in joins; a null is told from any value."""
    parts = [F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col)]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit("second"), *parts).alias("k2")]


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, and compare them.

    The edited text has its last half replaced by as many first characters of
    the next document in ascending id order (after the last, the first).

    Defined cases: a null text is empty; a null id comes first; rows that share
    an id are ordered by a hash of their text; wholly repeated rows take one
    place in the order and get the same result each; a table of one document
    follows itself; an empty table gives none. Other columns are not read.
    Where ``edited_too_short`` or ``next_too_short`` is true, the likeness and
    containment of that pair say nothing (see ``too_short``).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), *_row_key(id_col, text_col), text.alias("text")).withColumn(
        "n", F.char_length("text").cast("bigint")
    )
    # Order and neighbours come from ids and lengths alone; texts are not sorted.
    ranked = with_rank(
        keyed.select("id", "k1", "k2", "n").distinct(),
        F.col("id").asc_nulls_first(), F.col("k1"), F.col("k2"),
        total="n_all",
    )
    after = ranked.select(
        F.col("k1").alias("prev_k1"), F.col("k2").alias("prev_k2"), F.floor(F.col("n") / 2).alias("take"),
        (F.col("rank") % F.col("n_all") + 1).alias("rank"),
    )
    place = ranked.select("rank", "k1", "k2").join(after, "rank").drop("rank")
    # What a document hands to the one before it: the wanted characters and its
    # sketch. Its id and length go along and are returned, so that this side and
    # the other read the same columns and share one shuffle of the texts.
    given = (
        keyed.join(place, ["k1", "k2"])
        .withColumn("hashes", word_hashes(F.col("text")))
        .select(
            F.col("prev_k1").alias("k1"),
            F.col("prev_k2").alias("k2"),
            F.expr("left(text, cast(take as int))").alias("head"),
            sketch(F.col("hashes")).alias("next"),
            F.col("id").alias("next_id"),
            F.col("n").alias("next_n"),
        )
        # Repeated rows hand it over once.
        .withColumn("same", F.lag("k1").over(Window.partitionBy("k1", "k2").orderBy("k1")))
        .filter(F.col("same").isNull())
        .drop("same")
    )
    both = (
        keyed.join(given, ["k1", "k2"])
        .withColumn("hashes", word_hashes(F.col("text")))
        .withColumn("own", sketch(F.col("hashes")))
    )
    edited = F.concat(F.expr("left(text, cast(n - floor(n / 2) as int))"), F.col("head"))
    made = both.select("id", "n", "own", "next", "next_id", "next_n", edited.alias("edited_text")).withColumn(
        "edited_hashes", word_hashes(F.col("edited_text"))
    )
    sketched = made.withColumn("edited", sketch(F.col("edited_hashes"))).withColumn("sha", F.sha2("edited_text", 256))
    return sketched.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("edited")).alias("near_edited"),
        resemblance(F.col("own"), F.col("next")).alias("near_next"),
        containment(F.col("own"), F.col("edited")).alias("held_by_edited"),
        containment(F.col("own"), F.col("next")).alias("held_by_next"),
        too_short(F.col("own"), F.col("edited")).alias("edited_too_short"),
        too_short(F.col("own"), F.col("next")).alias("next_too_short"),
        F.col("next_id").alias("next_doc_id"),
        F.col("next_n").alias("next_n_chars"),
    )
