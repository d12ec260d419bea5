"""Jaccard join of documents on word shingles by PartEnum signatures.

1. Texts become shingle sets; equal sets form a class. From here on one class
   counts once, however many copies it has.
2. Every class gives its signatures. Classes that share one form a bucket; only
   buckets of several classes go on.
3. Buckets with the same first class are compared together. Bitmaps of the sets,
   a twentieth of their size, tell which classes may have a partner; the others
   go no further. The rest is compared with whole sets: at first each class only in the bucket group it
   shares most signatures with, which joins most that belongs together; then all
   classes of buckets that still hold several components. Inside a call every
   class meets all of other components, rare shingles first; a call returns links
   that join two components, so no more than it has classes.
4. Large groups of buckets go in blocks: first inside blocks, then, if components
   are still apart, in pairs of blocks.

So every pair of classes that share a signature is either compared or already in
one component, and no step makes more rows than classes in buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.graph import components
from merchlens.llm.part_enum import Bands, profile, signatures, with_possible_partner
from merchlens.llm.word_sets import set_key, shingle_sets
from merchlens.llm.worker import keeps_nothing
from merchlens.session import stage, together

# Bytes of whole sets that one call compares; larger buckets go in blocks of so many.
_CALL_BYTES = 24 << 20
# So many class keys (24 bytes each) are broadcast at most; more are joined by a shuffle.
_BROADCAST_KEYS = 200_000


def _describe(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, profiles = [], [], []
            for s in shingle_sets(batch.column("text"), words):
                keys.append(set_key(s))
                sizes.append(len(s))
                profiles.append(profile(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(profiles, pa.binary())],
                ["id", "text_hash", "key", "n", "profile"],
            )

    return keeps_nothing(run)


def _sign(words: int, num: int, den: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(num, den), set()
        for batch in batches:
            found, owners, rows = [], [], 0
            for s in shingle_sets(batch.column("text"), words):
                key = set_key(s)
                if key in seen:  # a copy met in this task gives nothing new
                    continue
                seen.add(key)
                found.append(signatures(s, bands))
                owners.append(np.full(len(found[-1]), key, np.int64))
                rows += len(found[-1])
                if rows > 200_000:
                    yield _signed(found, owners)
                    found, owners, rows = [], [], 0
            if found:
                yield _signed(found, owners)

    return keeps_nothing(run)


def _signed(found: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(owners))], ["sig", "key"])


def _sets(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([s.tobytes() for s in shingle_sets(batch.column("text"), words)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), sets], ["key", "elements"])

    return keeps_nothing(run)


def _elements(keys: DataFrame, classes: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """The whole sets of classes: (key, elements)."""
    wanted = stage(
        keys.select("key").distinct().join(classes.select("key", "rep"), "key")
        .select("key", F.col("rep.id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash")),
        "wanted",
    )
    few = wanted.count() <= _BROADCAST_KEYS
    texts = rows.join(
        F.broadcast(wanted) if few else wanted,
        (F.col("text_hash") == F.col("rep_hash")) & F.col("id").eqNullSafe(F.col("rep_id")),
    ).select("key", "text")
    elements = (
        texts.mapInArrow(_sets(words), "key long, elements binary")
        # Wholly repeated rows stand for their class once.
        .withColumn("same", F.lag("key").over(Window.partitionBy("key").orderBy("key")))
        .filter(F.col("same").isNull())
        .drop("same")
    )
    return stage(elements, "elements")


def _gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of runs, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def joining_links(sets: list[np.ndarray], label: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links between similar sets that join two components; ``label`` names each set's component and is changed.

    Two similar sets share one of their first n - ceil(t n) + 1 elements in any
    common order, so with the rarest elements first, only sets that share one of
    those are compared, in whole. Of a set's candidates those that share most go
    first; once one has joined it to a component, the others there are left out.
    """
    sizes = np.array([len(s) for s in sets])
    by_size = np.argsort(sizes, kind="stable")
    starts = np.cumsum(sizes) - sizes
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.lexsort((element, times[element], owner))
    rare_first = element[order]
    head = np.arange(len(element)) - np.repeat(starts, sizes) < np.repeat(sizes - -(-num * sizes // den) + 1, sizes)
    head_element, head_owner = rare_first[head], owner[head]
    place = np.argsort(head_element, kind="stable")
    posted = head_owner[place]
    first = np.searchsorted(head_element[place], np.arange(len(times) + 1))
    head_starts = np.searchsorted(head_owner, np.arange(len(sets) + 1))
    turn = np.empty(len(sets), np.int64)
    turn[by_size] = np.arange(len(sets))
    marked = np.zeros(len(times), bool)
    out = []
    for a in by_size:
        own = head_element[head_starts[a] : head_starts[a + 1]]
        met = posted[_gathered(first[own], first[own + 1] - first[own])]
        met = met[(turn[met] < turn[a]) & (label[met] != label[a]) & (den * sizes[met] >= num * sizes[a])]
        if not len(met):
            continue
        near, shared = np.unique(met, return_counts=True)
        near = near[np.argsort(-shared, kind="stable")]
        marked[element[starts[a] : starts[a] + sizes[a]]] = True
        step = 8
        while len(near):
            some, near = near[:step], near[step:]
            both = np.add.reduceat(marked[element[_gathered(starts[some], sizes[some])]], np.cumsum(sizes[some]) - sizes[some], dtype=np.int64)
            for b in some[den * both >= num * (sizes[some] + sizes[a] - both)]:
                if label[a] != label[b]:
                    label[label == label[b]] = label[a]
                    out.append((int(a), int(b)))
            near, step = near[label[near] != label[a]], min(step * 4, 512)
        marked[element[starts[a] : starts[a] + sizes[a]]] = False
    return out


def _join(num: int, den: int) -> Callable:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # A class may be in several buckets of the call.
        frame = frame.drop_duplicates("key")
        keys = frame["key"].to_numpy()
        label = np.unique(frame["comp"].to_numpy(), return_inverse=True)[1]
        links = joining_links([np.frombuffer(e, np.uint64) for e in frame["elements"]], label, num, den)
        a, b = (keys[[link[side] for link in links]] if links else np.zeros(0, np.int64) for side in (0, 1))
        return pd.DataFrame({"a": a, "b": b})

    return run


def _open_classes(shared: DataFrame, comps: DataFrame) -> DataFrame:
    """Classes in buckets that hold several components, by the first class of the bucket: (hub, key, comp)."""
    members = shared.select("sig", "hub", "key").union(shared.select("sig", "hub", F.col("hub").alias("key")).distinct())
    placed = members.join(comps.toDF("key", "comp"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    mixed = placed.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("sig")
    return placed.join(mixed, "sig", "left_semi").select("hub", "key", "comp").distinct()


def _in_calls(todo: DataFrame, bytes_of: DataFrame, across: bool) -> tuple[DataFrame, DataFrame]:
    """Classes of one hub dealt to calls, (call, blocks, low, high, hub, key, comp), and the hubs with several blocks.

    ``bytes_of``: (key, bytes). Small hubs share calls; larger ones go in blocks, of which each has a call of its own,
    or with ``across`` each pair of blocks.
    """
    sized = todo.join(bytes_of, "key")
    hubs = sized.groupBy("hub").agg(F.sum("bytes").alias("bytes"))
    hubs = stage(hubs.select("hub", "bytes", F.ceil(F.col("bytes") / _CALL_BYTES).cast("int").alias("blocks")), "hubs")
    held = hubs.filter("blocks = 1").agg(F.sum("bytes")).first()[0] or 0
    blocks = todo.join(hubs.select("hub", "blocks"), "hub").withColumn("block", F.pmod(F.xxhash64("key", "hub"), F.col("blocks")).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)) if across else F.col("block"))
    call = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("hub"), F.lit(held // _CALL_BYTES + 1))).otherwise(F.col("hub"))
    calls = blocks.select(
        call.alias("call"), "blocks", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "hub", "key", "comp"
    )
    return calls, hubs.filter("blocks > 1").select("hub")


def _promising(num: int, den: int) -> Callable:
    bands = Bands(num, den)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("hub", kind="stable")
        hubs, sizes, label = frame["hub"].to_numpy(), frame["n"].to_numpy(), frame["comp"].to_numpy()
        profiles = frame["profile"].tolist()
        keep = np.zeros(len(frame), bool)
        edges = [0, *(np.flatnonzero(np.diff(hubs)) + 1).tolist(), len(hubs)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            keep[a:b] = with_possible_partner(profiles[a:b], sizes[a:b], label[a:b], bands)
        return frame.loc[keep, ["hub", "key", "comp"]]

    return run


def _joins(
    todo: DataFrame, classes: DataFrame, rows: DataFrame, words: int, across: bool, num: int, den: int
) -> tuple[DataFrame, DataFrame]:
    """Links that join components, among classes of one hub, inside blocks or with ``across`` over all pairs of
    blocks; and the hubs that went in several blocks."""
    calls, large = _in_calls(todo, classes.select("key", F.length("profile").alias("bytes")), across)
    found = calls.join(classes.select("key", "n", "profile"), "key").groupBy("call", "blocks", "low", "high")
    likely = stage(found.applyInPandas(_promising(num, den), "hub long, key long, comp long").distinct(), "likely")
    calls, also = _in_calls(likely, classes.select("key", (F.col("n") * 8).alias("bytes")), across)
    elements = _elements(likely, classes, rows, words)
    links = calls.drop("hub").join(elements, "key").groupBy("call", "blocks", "low", "high").applyInPandas(_join(num, den), "a long, b long")
    return stage(links, "found"), large.union(also).distinct()


def jaccard_groups(
    docs: DataFrame, num: int = 80, den: int = 100, words: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Group documents whose word shingle sets have a Jaccard likeness of at least num / den.

    Returns one row per row of ``docs``: the id, ``n_shingles`` (size of its
    set) and ``component_id``, the smallest id reachable over links.

    Defined cases: words are runs without ASCII blanks, A-Z as a-z. A text with
    fewer words than a shingle has its whole sequence as one shingle; a null
    text, or one without words, has an empty set, links with nothing and is its
    own component. Rows that share an id count each by their own text. Rows
    without an id link like others but name no component, unless it has no id
    at all. Other columns are not read. An empty table gives none.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash")
    )
    described = stage(
        together(rows.mapInArrow(_describe(words), "id long, text_hash long, key long, n long, profile binary")), "sets"
    )
    classes = stage(
        described.filter("n > 0")
        .groupBy("key")
        .agg(
            F.first("n").alias("n"),
            F.first("profile").alias("profile"),
            F.min("id").alias("least_id"),
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("rep"),
        ),
        "classes",
    )
    in_bucket = Window.partitionBy("sig").orderBy("key")
    shared = (
        rows.select("text")
        .mapInArrow(_sign(words, num, den), "sig long, key long")
        .withColumn("hub", F.first("key").over(in_bucket))
        .withColumn("before", F.lag("key").over(in_bucket))
        .filter("key > hub and key > before")
        .select("sig", "key", "hub")
    )
    shared = stage(together(shared), "shared")
    hubs = shared.select("hub", F.col("hub").alias("key")).distinct()
    closest = shared.groupBy("key", "hub").agg(F.count("*").alias("c")).groupBy("key").agg(F.max_by("hub", "c").alias("hub"))
    todo = stage(closest.select("hub", "key").union(hubs).withColumn("comp", F.col("key")), "open")
    comps = None
    # First each class with its closest, then all that is still apart, both inside blocks; then large hubs over all pairs of blocks.
    for across in (None, False, True):
        if across is not None:
            todo = _open_classes(shared, comps)
            todo = stage(todo.join(large, "hub", "left_semi") if across else todo, "open")
        if todo.isEmpty():
            break
        links, large = _joins(todo, classes, rows, words, bool(across), num, den)
        # Components stand for the links that made them.
        comps = stage(components(links if comps is None else comps.toDF("a", "b").union(links), "a", "b"), "comps")
    if comps is None:
        comps = classes.select("key", F.col("key").alias("comp")).limit(0)
    named = (
        classes.select("key", "least_id").join(comps.toDF("key", "comp"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    )
    least = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    names = named.select("key", "comp").join(least, "comp").select("key", "component_id")
    return (
        described.select("id", "key", "n")
        .join(names, "key", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
    )


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: those with the smallest id.

    Rows without an id, or without words, all stay. Rows that share the
    smallest id of a group all stay, so ids should be unique.
    """
    groups = jaccard_groups(docs, id_col=id_col, text_col=text_col).toDF("id", "n_shingles", "least")
    gone = groups.filter("id <> least").select(F.col("id").alias("gone_id")).distinct()
    # The input's columns stay inside one struct, so no name can clash.
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"))
    return rows.join(gone, F.col("id") == F.col("gone_id"), "left_anti").select("row.*")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, len(s) AS n FROM sets
), shingles AS (
  SELECT doc_id, hash(unnest(s)) AS h FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  WHERE 100 * least(m.n, n.n) >= 80 * greatest(m.n, n.n)
  GROUP BY a.doc_id, b.doc_id, m.n, n.n
  HAVING 100 * count(*) >= 80 * (m.n + n.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS v, doc_id AS seen FROM documents
  UNION
  SELECT r.v, e.b FROM reach r JOIN both_ways e ON r.seen = e.a
)
SELECT s.doc_id, s.n AS n_shingles, r.component_id
FROM sizes s JOIN (SELECT v, min(seen) AS component_id FROM reach GROUP BY v) r ON r.v = s.doc_id
"""
