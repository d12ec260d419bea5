"""Token-id files: documents in id order, tokenized, compressed by Re-Pair shard by shard.

Texts are range-partitioned by id; each task tokenizes its range and writes
shards of bounded size as rows of a Parquet folder (one binary payload each,
see ``repair``), by Spark's own committed writer, so a lost executor leaves no
half-written file. Rows carry the place of the shard, so every document's
position in the whole corpus follows from one number per task.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlens.llm.repair import Shard, pack
from merchlens.llm.units import UnitTable, column_batches
from merchlens.llm.worker import kept

SHARD_IDS = 2_000_000
END_ID = 0
_SHARD_SCHEMA = "part int, shard int, before long, n_ids long, first long, doc_ids array<long>, payload binary"
# Texts of a task are taken in batches of about this many characters.
_BATCH_CHARS = 1_500_000
_UNIT_CHARS = 8_000_000  # of which units are looked up at once


# So many units are handed to the tokenizer as one text.
_JOINED = 100
_AT_ONCE = 20  # such texts


def byte_bpe_units(path: str) -> UnitTable:
    """Units of a tokenizers-library file that splits before single spaces, as byte-level BPE does.

    Units that begin with such a space follow each other as they would in a
    text; how many bytes each token stands for tells where one ends. Others
    stand between special tokens, which cut a text before anything else happens
    to it, so they get the ids that each gets alone.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(path)
    added = tokenizer.get_added_tokens_decoder()
    between, mark = next((i, t.content) for i, t in added.items() if t.special)
    sizes = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
    for token, i in tokenizer.get_vocab().items():
        # A byte-level token has one character for each byte.
        sizes[i] = len(added[i].content.encode()) if i in added else len(token)
    sizes[between] = 0

    def run(texts: list[str]) -> np.ndarray:
        found = []
        # A few at a time, so that their encodings stay near the processor.
        for i in range(0, len(texts), _AT_ONCE):
            found += [np.array(e.ids, np.int64) for e in tokenizer.encode_batch_fast(texts[i : i + _AT_ONCE], add_special_tokens=False)]
        return np.concatenate(found)

    def apart(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if any(mark in u for u in units):
            found = [e.ids for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.int64), np.array(list(map(len, found)), np.int64)
        ids = run([mark.join(units[i : i + _JOINED]) + mark for i in range(0, len(units), _JOINED)])
        ends = np.flatnonzero(ids == between)
        return ids[ids != between], np.diff(ends, prepend=-1) - 1

    def encode(units: list[str], joining: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if any(mark in u for u in units):
            return apart(units)
        parts = [u if j else mark + u + mark for u, j in zip(units, joining.tolist(), strict=True)]
        ids = run(["".join(parts[i : i + _JOINED]) for i in range(0, len(parts), _JOINED)])
        ids = ids[ids != between]
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, units)), np.int64, len(units)))
        reached = np.cumsum(sizes[ids])
        stops = np.searchsorted(reached, ends, side="right")
        # Where tokens do not end with their units (no byte-level tokens), units are taken apart.
        if not np.array_equal(np.concatenate([[0], reached])[stops], ends):
            return apart(units)
        return ids, np.diff(stops, prepend=0)

    # Byte-level BPE's own pattern ends a run of letters before these marks, and runs of them before white space.
    splitter = tokenizer.pre_tokenizer
    apart_from_letters = isinstance(splitter, ByteLevel) and splitter.use_regex and tokenizer.normalizer is None
    return UnitTable(encode, ends=".,;:!?" if apart_from_letters else "")


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def text_batches(texts: list[str | None], chars: int = _BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``chars`` characters, with the place of the first; a null is empty."""
    at, batch, size = 0, [], 0
    for text in texts:
        batch.append(text or "")
        size += len(batch[-1])
        if size >= chars:
            yield at, batch
            at, batch, size = at + len(batch), [], 0
    if batch:
        yield at, batch


def _writer(path: str, first: int, end_id: int, shard_ids: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: UnitTable = kept("token files", f"units:{path}", lambda: byte_bpe_units(path))
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, ids, lengths, held, shard, before
            payload = pack(np.concatenate(ids), np.concatenate(lengths), first)
            row = [[part], [shard], [before], [held], [first], [docs], [payload]]
            before, shard = before + held, shard + 1
            docs, ids, lengths, held = [], [], [], 0
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "shard", "before", "n_ids", "first", "doc_ids", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            names = batch.column("id").to_pylist()
            for at, texts in column_batches(batch.column("text"), _UNIT_CHARS):
                found, counts = units.ids(texts)
                found = np.insert(found, np.cumsum(counts), end_id)
                ends = np.concatenate([[0], np.cumsum(counts + 1)])
                a = 0
                while a < len(texts):
                    b = min(int(np.searchsorted(ends, ends[a] + shard_ids - held)), len(texts))
                    ids.append(found[ends[a] : ends[b]])
                    lengths.append(counts[a:b] + 1)
                    docs += names[at + a : at + b]
                    held += len(ids[-1])
                    a = b
                    if held >= shard_ids:
                        yield flush()
        if docs:
            yield flush()

    return run


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Tokenize every whole text and write the ids, in ascending id order, as shards under ``path``.

    ``end_id`` is appended to each document. Defined cases: a null or empty text
    is its end id alone; a null id comes first; rows that share an id are
    ordered by a hash of their text, and repeated rows stand next to each other;
    other columns are not read; an empty table writes no shard. A shard is
    closed with the document that fills it, so it may be longer by one document.
    """
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    shards = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_writer(vocabulary, vocabulary_size(vocabulary), end_id, shard_ids), _SHARD_SCHEMA)
    )
    shards.write.parquet(path)


def _reader(summary: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, doc_ids, payload in zip(
                *(batch.column(c).to_pylist() for c in ("part", "before", "doc_ids", "payload")), strict=True
            ):
                shard = Shard(payload)
                ids = shard.expand(shard.symbols).astype("<u4")
                ends = np.cumsum(shard.id_counts)
                starts = ends - shard.id_counts
                columns = [
                    pa.array(np.full(len(ends), part, np.int32)),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(before + starts),
                    pa.array(shard.id_counts),
                ]
                names = ["part", "id", "place", "n_tokens"]
                spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
                if summary:
                    columns.append(pa.array([zlib.crc32(ids[a:b]) for a, b in spans], pa.int64()))
                    names.append("ids_crc32")
                else:
                    offsets = pa.array(np.concatenate([[0], ends]), pa.int64())
                    columns.append(pa.LargeListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))).cast(pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def read_token_files(spark: SparkSession, path: str, summary: bool = False) -> DataFrame:
    """Read shards back: per document its id, ``start`` (ids of all documents before it), ``n_tokens``, and its
    ids, or with ``summary`` their CRC-32 as little-endian unsigned 32-bit integers (``ids_crc32``)."""
    shards = spark.read.parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("ids_in"))
    # One row per writing task: its window and its broadcast are bounded by their number.
    offsets = totals.select(
        "part", (F.sum("ids_in").over(Window.orderBy("part")) - F.col("ids_in")).alias("part_start")
    )
    last = "ids_crc32" if summary else "ids"
    rows = shards.select("part", "before", "doc_ids", "payload").mapInArrow(
        _reader(summary), f"part int, id long, place long, n_tokens long, {last} {'long' if summary else 'array<int>'}"
    )
    return rows.join(F.broadcast(offsets), "part").select(
        F.col("id").alias("doc_id"), (F.col("part_start") + F.col("place")).alias("start"), "n_tokens", last
    )
