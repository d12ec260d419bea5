"""Near-duplicate vectors by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard
transform; its hash is the axis, with sign, to which the turned vector is
closest. Several such hashes make a bucket code, several codes make tables, and
each table also looks into the buckets of the next closest axes (multiprobe).
Vectors that meet in a bucket are compared exactly in double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.graph import components
from merchlens.session import stage

TABLES = 10
PROBES = 4  # buckets a table looks into: the vector's own and three next ones
# Members in a block of a large bucket, and rows of small buckets compared by one call.
_BLOCK = 1024
_ROWS_A_CALL = 20_000


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, width, h = x.shape[0], x.shape[1], 1
    while h < width:
        pairs = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def polytope_codes(x: np.ndarray, hashes: int, tables: int, probes: int, seed: int = 7) -> np.ndarray:
    """Bucket codes of unit vectors, shaped (vectors, tables, probes); the first probe is the own bucket."""
    n, dim = x.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = x
    rng = np.random.default_rng(seed)
    base = 2 * width
    out = np.empty((n, tables, probes), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        best, second, loss = [], [], []
        for _ in range(hashes):
            y = padded
            for _ in range(3):
                y = _hadamard(y * rng.choice([-1.0, 1.0], width))
            size = np.abs(y)
            first = size.argmax(axis=1)
            top = size[rows, first]
            size[rows, first] = -1.0
            runner = size.argmax(axis=1)
            best.append(first * 2 + (y[rows, first] < 0))
            second.append(runner * 2 + (y[rows, runner] < 0))
            loss.append(top - size[rows, runner])
        codes = np.stack(best)  # hashes x vectors
        power = base ** np.arange(hashes, dtype=np.int64)[:, None]
        own = (codes * power).sum(axis=0)
        # The next buckets take the second axis in place of the first, for the hashes in
        # which the two are closest; then in two hashes at once.
        step = (np.stack(second) - codes) * power
        sets = [[i] for i in range(hashes)] + [[i, j] for i in range(hashes) for j in range(i)]
        cost = np.stack([sum(loss[i] for i in s) for s in sets])
        moved = np.stack([own + sum(step[i] for i in s) for s in sets])
        order = np.argsort(cost, axis=0, kind="stable")[: probes - 1]
        out[:, t, 0] = own
        out[:, t, 1:] = -1
        out[:, t, 1 : 1 + len(order)] = np.take_along_axis(moved, order, axis=0).T
    return out


def _coder(hashes: int, tables: int, probes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            codes: list = [None] * len(vectors)
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_length.setdefault(len(v), []).append(i)
            for members in by_length.values():
                x = np.array([vectors[i] for i in members], np.float64)
                # Scaled by the largest component first, so that no square overflows or vanishes.
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for i, c in zip(members, polytope_codes(x, hashes, tables, probes), strict=True):
                    codes[i] = c.ravel()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rep", "label", "copies", "vector")), pa.array(codes, pa.list_(pa.int64()))],
                ["rep", "label", "copies", "vector", "codes"],
            )

    return run


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _met_before(codes: np.ndarray, a: np.ndarray, b: np.ndarray, place: int, probes: int, code: int) -> np.ndarray:
    """Whether pairs (a, b) also share an earlier bucket: one of an earlier table, or one
    of this table with a smaller code. So each pair counts in one bucket only."""
    out = np.zeros(len(a), bool)
    for t in range(place + 1):
        left, right = codes[a, t * probes : (t + 1) * probes], codes[b, t * probes : (t + 1) * probes]
        for p in range(probes):
            same = (left[:, p : p + 1] == right) & (right >= 0)
            if t == place:
                same &= right < code
            out |= same.any(axis=1)
    return out


def _compare(threshold: float, probes: int) -> Callable:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for (table, code, _, _), bucket in frame.groupby(["table", "code", "label", "dim"], sort=False):
            if len(bucket) < 2:
                continue
            reps, copies = bucket["rep"].to_numpy(), bucket["copies"].to_numpy()
            x, codes = _unit(bucket["vector"]), np.stack(bucket["codes"].to_numpy())
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            if bucket["low"].iloc[0] != bucket["high"].iloc[0]:
                blocks = bucket["block"].to_numpy()
                near &= blocks[:, None] != blocks[None, :]
            a, b = np.nonzero(np.triu(near, 1))
            if not len(a):
                continue
            # Components need every link, counts each link once.
            least = np.arange(len(reps))
            while True:
                spread = least.copy()
                np.minimum.at(spread, a, least[b])
                np.minimum.at(spread, b, least[a])
                spread = spread[spread]
                if (spread == least).all():
                    break
                least = spread
            fresh = ~_met_before(codes, a, b, int(table), probes, int(code))
            count = np.bincount(a[fresh], weights=copies[b[fresh]], minlength=len(reps))
            count += np.bincount(b[fresh], weights=copies[a[fresh]], minlength=len(reps))
            linked = np.flatnonzero(near.any(axis=1))
            found.append((reps[linked], count[linked].astype(np.int64), reps[least[linked]]))
        parts = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        out = pd.DataFrame({"rep": parts[0], "links": parts[1], "peer": parts[2]})
        return out.groupby(["rep", "peer"], as_index=False)["links"].sum()[["rep", "links", "peer"]]

    return run


def embedding_groups(
    vectors: DataFrame,
    threshold: float = 0.98,
    tables: int = TABLES,
    probes: int = PROBES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Link vectors of one label whose cosine is at least ``threshold``, and group them by their links.

    Returns one row per row of ``vectors``: the id, ``n_links`` (other rows
    linked directly), ``component_id`` (the smallest id reachable, itself
    included) and ``kept`` (whether that is its own). Equal vectors are one
    class and counted, not compared. A bucket of any size is compared whole, in
    pairs of blocks; a call returns counts and one peer per vector, not pairs.

    Defined cases: a null label or vector, an empty or zero vector, or one with
    a null or non-finite component links with nothing. Vectors of different
    lengths are not compared. Rows without an id count as rows in ``n_links``
    but name no component; an unlinked row's component is its own id. Rows that
    share an id are rows of their own. Other columns are not read. An empty
    table gives none.
    """
    value = F.col("vector")
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    sound = (
        F.col("label").isNotNull()
        & value.isNotNull()
        & F.coalesce(F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists(value, lambda v: v != 0), F.lit(False))
    )
    keyed = rows.select(
        "id",
        "label",
        "vector",
        F.when(sound, F.xxhash64("label", "vector")).alias("k1"),
        F.when(sound, F.xxhash64(F.lit("second"), "label", "vector")).alias("k2"),
    )
    classes = stage(
        keyed.filter(F.col("k1").isNotNull())
        .groupBy("k1", "k2")
        .agg(
            F.count("*").alias("copies"), F.min("id").alias("least_id"), F.first("label").alias("label"), F.first("vector").alias("vector")
        )
        .withColumn("rep", F.xxhash64("k1", "k2")),
        "vector-classes",
    )
    largest = classes.groupBy("label", F.size("vector").alias("dim")).count().agg(F.max("count"), F.max("dim")).first()
    axes = 2 << max(1, ((largest[1] or 2) - 1).bit_length())
    # As many hashes a code as make more buckets than a label has vectors, so buckets stay small at any size.
    hashes = 2
    while axes**hashes < (largest[0] or 1):
        hashes += 1
    coded = stage(
        classes.select("rep", "label", "copies", "vector").mapInArrow(
            _coder(hashes, tables, probes), f"rep long, label {dict(classes.dtypes)['label']}, copies long, vector array<double>, codes array<long>"
        ),
        "vector-codes",
    )
    places = coded.select("rep", "label", F.size("vector").alias("dim"), F.posexplode("codes").alias("place", "code")).select(
        "rep", "label", "dim", F.floor(F.col("place") / probes).alias("table"), "code"
    ).filter("code >= 0")
    bucket = ["table", "code", "label", "dim"]
    sizes = stage(places.groupBy(*bucket).agg(F.count("*").alias("size")).filter("size > 1"), "bucket-sizes")
    rows_in = sizes.agg(F.sum("size")).first()[0] or 0
    calls = rows_in // _ROWS_A_CALL + 1
    todo = (
        places.join(sizes, bucket)
        .withColumn("blocks", F.ceil(F.col("size") / _BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("rep", "table"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .withColumn(
            "call", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64(*bucket), F.lit(calls))).otherwise(F.xxhash64(*bucket))
        )
        .join(coded.select("rep", "copies", "vector", "codes"), "rep")
        .select("rep", "copies", "vector", "codes", *bucket, "blocks", "block", "low", "high", "call")
    )
    found = stage(
        todo.groupBy("call", "blocks", "low", "high").applyInPandas(_compare(threshold, probes), "rep long, links long, peer long"),
        "vector-links",
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comps = components(found, "rep", "peer").toDF("rep", "comp")
    named = (
        classes.select("k1", "k2", "rep", "copies", "least_id")
        .join(counts, "rep", "left")
        .join(comps, "rep", "left")
        .withColumn("comp", F.coalesce("comp", "rep"))
        .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    )
    least = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    by_class = named.join(least, "comp").select("k1", "k2", "n_links", "component_id")
    component = F.when(F.coalesce("n_links", F.lit(0)) > 0, F.col("component_id")).otherwise(F.col("id"))
    return (
        keyed.select("id", "k1", "k2")
        .join(by_class, ["k1", "k2"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
        )
    )


SQL = r"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS v, vec_id AS seen FROM embeddings
  UNION
  SELECT r.v, l.b FROM reach r JOIN links l ON r.seen = l.a
), comps AS (
  SELECT v, min(seen) AS component_id FROM reach GROUP BY v
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT c.v AS vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.v = c.component_id AS kept
FROM comps c LEFT JOIN counts n ON n.a = c.v
"""
