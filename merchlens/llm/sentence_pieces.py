"""Sampled SentencePiece segmentation over the piece lattice, and lossless decoding.

Every way to cut a text into vocabulary pieces is a path through a lattice; a
path weighs exp(theta * sum of its pieces' scores). Forward filtering sums the
weights of all paths to each position; backward sampling then draws one path
from its end, exactly in proportion to the weights. The random numbers come
from the row's key, the unit's place in the text and the step, so a row gets the
same path wherever and whenever it is encoded.

As no piece goes on past a space that follows another character, the lattice of
a text falls into those of its units; as no piece holds two neighbours that no
piece of the vocabulary has side by side, that of a unit falls into those of its
links. Every path meets between two links, so each is filtered once per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.units import Units, column_batches
from merchlens.llm.word_sets import _STEP, mix
from merchlens.llm.worker import kept

THETA = 2e-4
_SPACE = 0x2581  # how a space is written in pieces
_RAW = 0x110000  # added to a text's own U+2581, which no piece may match
_U = np.uint64
_DECODE_ROWS = 200
_BATCH_CHARS = 500_000  # texts sampled at once
_FILTER_CHARS = 50_000  # links filtered at once
_TABLE_BYTES = 48 << 20  # lattices a worker keeps


class Vocabulary:
    """Pieces of a model file, as bytes for decoding and as prefix hashes for the lattice."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.as_bytes: list[bytes] = []
        self.byte_id = np.full(256, -1, np.int64)
        plain: dict[str, tuple[int, float]] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.as_bytes.append(bytes([value]))
                continue
            special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            self.as_bytes.append(b"" if special else piece.replace(chr(_SPACE), " ").encode())
            if not special:
                plain[piece] = (i, model.get_score(i))
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces, so not every text has a path")
        # Units are cut before a space that follows another character.
        if any(chr(_SPACE) in p.lstrip(chr(_SPACE)) for p in plain):
            raise ValueError("a piece goes on past a space")
        self.lowest = min(s for _, s in plain.values())
        self.longest = max(map(len, plain))
        # Each prefix of a piece: its hash, and the piece it is, if any.
        prefixes: dict[int, tuple[int, float]] = {}
        for piece, found in plain.items():
            h = 0
            for j, c in enumerate(piece):
                h = (h * int(_STEP) + ord(c) + 1) % (1 << 64)
                if j + 1 < len(piece):
                    prefixes.setdefault(h, (-1, 0.0))
                else:
                    prefixes[h] = found
        # Neighbours within a piece; no piece goes over any others.
        self.pairs = pa.array(sorted({_pair(ord(a), ord(b)) for p in plain for a, b in zip(p, p[1:], strict=False)}), pa.int64())
        order = sorted(prefixes)
        self.hashes = np.array(order, np.uint64)
        self.ids = np.array([prefixes[h][0] for h in order], np.int64)
        self.scores = np.array([prefixes[h][1] for h in order])

        self.sizes = np.fromiter(map(len, self.as_bytes), np.int64, size)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.as_bytes), np.uint8)

    def decode(self, ids: list[int]) -> str:
        """The text of a segmentation; the space put before every text goes again."""
        return b"".join(map(self.as_bytes.__getitem__, ids)).decode()[1:]

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[bytes]:
        """The texts, as UTF-8, of segmentations that stand one after the other."""
        bounds = np.concatenate([[0], np.cumsum(counts)])
        # In runs, so that the working memory is bounded.
        for a in range(0, len(counts), _DECODE_ROWS):
            b = min(a + _DECODE_ROWS, len(counts))
            own = ids[bounds[a] : bounds[b]]
            sizes = self.sizes[own]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            at = np.arange(ends[-1]) + np.repeat(self.starts[own] - ends[:-1], sizes)
            text = self.flat[at].tobytes()
            cuts = ends[bounds[a : b + 1] - bounds[a]].tolist()
            yield from (text[x + 1 : y] for x, y in zip(cuts, cuts[1:], strict=False))


def _pair(a, b):
    return a * (1 << 22) + b


class _Column:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.size, self.room = 0, np.empty(1024, kind)

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.room):
            room = np.empty(2 * size, self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : size] = values
        self.size = size

    @property
    def nbytes(self) -> int:
        return self.size * self.room.itemsize

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.room[at]


class Lattices(Units):
    """Filtered lattices of the links that units consist of.

    Nodes are positions in links, numbered through; ``head`` is the first of the
    edges that end at a node. ``cuts`` holds, for every edge, the probability
    that it or one before it at its node is taken on the way back. A unit's
    links are those in ``chain`` from ``begin`` to ``end``.
    """

    def __init__(self, vocabulary: Vocabulary, theta: float, limit: int = 200_000):
        self.vocabulary, self.theta = vocabulary, theta
        self.links: dict[str, int] = {}
        super().__init__(limit)

    def forget(self) -> None:
        super().forget()
        self.chain, self.begin, self.end = _Column(np.int32), _Column(np.int32), _Column(np.int32)
        # Links are kept when units are forgotten, while there is room.
        if not self.links or self._heavy():
            self.links = {}
            self.first, self.last, self.head = _Column(np.int32), _Column(np.int32), _Column(np.int32)
            self.cuts = _Column(np.float64)
            self.origin = _Column(np.int32)
            self.token = _Column(np.int32)  # a piece's id, or -1 - code point for one spelled in bytes

    def _heavy(self) -> bool:
        return sum(a.nbytes for a in (self.first, self.last, self.head, self.cuts, self.origin, self.token)) > _TABLE_BYTES

    def full(self) -> bool:
        return super().full() or self._heavy()

    def learn(self, strings: list[str], begins: bool, clean: np.ndarray) -> None:
        # The text's first unit gets the space that every text begins with.
        text = "".join([" " + s for s in strings] if begins else strings)
        bounds = np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings)) + begins)
        codes = _codes(text)
        apart = np.ones(len(codes), bool)
        inside = pc.is_in(pa.array(_pair(codes[:-1], codes[1:])), self.vocabulary.pairs)
        apart[1:] = ~inside.to_numpy(zero_copy_only=False)
        apart[bounds[:-1]] = True
        cuts = np.append(np.flatnonzero(apart), len(codes))
        places = cuts.tolist()
        links = [text[a:b] for a, b in zip(places, places[1:], strict=False)]
        new = [k for k in dict.fromkeys(links) if k not in self.links]
        self.links.update(zip(new, range(len(self.links), len(self.links) + len(new)), strict=True))
        for _, some in column_batches(pa.array(new, pa.string()), _FILTER_CHARS):
            self._filter(some.to_numpy(zero_copy_only=False).tolist())
        ends = len(self.chain) + np.searchsorted(cuts, bounds)
        self.begin.add(np.append(len(self.chain), ends[:-1]))
        self.end.add(ends)
        self.chain.add(np.fromiter(map(self.links.__getitem__, links), np.int32, len(links)))

    def _filter(self, links: list[str]) -> None:
        """Take in the lattices of new links."""
        sizes = np.fromiter(map(len, links), np.int64, len(links))
        codes = _codes("".join(links))
        ends = np.cumsum(sizes)
        starts, tokens, weights, stops = self._edges(codes, np.repeat(ends, sizes))
        # A node stands before every character and one more at the end of each link.
        link_of = np.repeat(np.arange(len(sizes)), sizes)
        source = starts + link_of[starts]
        target = stops + link_of[stops - 1]
        depth = (stops - (ends - sizes)[link_of[stops - 1]]).astype(np.int64)
        order = np.lexsort((source, target, depth))
        source, target, weight, token, depth = source[order], target[order], weights[order], tokens[order], depth[order]
        alpha = np.zeros(int(sizes.sum()) + len(sizes))
        chance = np.empty(len(source))
        levels = np.flatnonzero(np.diff(depth, prepend=-1))
        for a, b in zip(levels, [*levels[1:], len(depth)], strict=True):
            way = alpha[source[a:b]] + weight[a:b]
            heads = np.flatnonzero(np.diff(target[a:b], prepend=-1))
            runs = np.diff(heads, append=b - a)
            top = np.maximum.reduceat(way, heads)
            share = np.exp(way - np.repeat(top, runs))
            total = np.add.reduceat(share, heads)
            alpha[target[a + heads]] = top + np.log(total)
            summed = np.cumsum(share)
            before = np.repeat(summed[heads] - share[heads], runs)
            chance[a:b] = np.minimum((summed - before) / np.repeat(total, runs), 1.0)
            chance[a + np.append(heads[1:], b - a) - 1] = 1.0
        order = np.argsort(target, kind="stable")
        base, edges = len(self.head), len(self.cuts)
        heads = edges + np.searchsorted(target[order], np.arange(len(alpha)))
        last = ends + np.arange(len(sizes))
        grown = {"head": heads, "cuts": chance[order], "origin": base + source[order], "token": token[order],
                 "first": base + last - sizes, "last": base + last}
        for name, values in grown.items():
            getattr(self, name).add(values)

    def _edges(self, codes: np.ndarray, link_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in the links as (start, token, weight, stop); a character that is no piece is spelled in bytes."""
        v = self.vocabulary
        at = np.arange(len(codes))
        h = np.zeros(len(codes), np.uint64)
        starts, tokens, weights, stops = [], [], [], []
        single = np.zeros(len(codes), bool)
        with np.errstate(over="ignore"):
            for length in range(1, v.longest + 1):
                h = h * _STEP + (codes[at + length - 1] + 1).astype(np.uint64)
                k = np.minimum(np.searchsorted(v.hashes, h), len(v.hashes) - 1)
                known = v.hashes[k] == h
                whole = known & (v.ids[k] >= 0)
                starts.append(at[whole])
                tokens.append(v.ids[k[whole]])
                weights.append(self.theta * v.scores[k[whole]])
                stops.append(at[whole] + length)
                if length == 1:
                    single[at[whole]] = True
                on = known & (at + length < link_end[at])
                at, h = at[on], h[on]
                if not len(at):
                    break
        spelled = np.flatnonzero(~single)
        starts.append(spelled)
        tokens.append(-1 - codes[spelled])
        weights.append(np.full(len(spelled), self.theta * self.vocabulary.lowest))
        stops.append(spelled + 1)
        return tuple(np.concatenate(x) for x in (starts, tokens, weights, stops))

    def sample(self, texts: pa.Array | list[str | None], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One sampled segmentation of each text: all ids one after the other, and how many each text has."""
        every, counts = self.units(texts)
        doc = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(every)) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            seed = mix(keys.astype(np.int64).view(np.uint64)[doc] ^ mix((place.astype(np.uint64) + _U(1)) * _STEP))
        link, begin = self.end[every] - 1, self.begin[every]
        node, stop = self.last[self.chain[link]], self.first[self.chain[link]]
        live = np.arange(len(every))
        steps, sizes = [], np.zeros(len(every), np.int64)
        step = 0
        while len(live):
            with np.errstate(over="ignore"):
                drawn = (mix(seed[live] + _U(step) * _STEP) >> _U(12)).astype(np.float64) * 2.0**-52
            edge = self.head[node[live]].astype(np.int64)
            on = np.flatnonzero(self.cuts[edge] <= drawn)
            while len(on):
                edge[on] += 1
                on = on[self.cuts[edge[on]] <= drawn[on]]
            steps.append((live, self.token[edge]))
            sizes[live] += 1
            node[live] = self.origin[edge]
            left = live[node[live] == stop[live]]
            left = left[link[left] > begin[left]]
            link[left] -= 1
            own = self.chain[link[left]]
            node[left], stop[left] = self.last[own], self.first[own]
            live = live[node[live] != stop[live]]
            step += 1
        # Steps run from the end of a unit to its start.
        tokens = np.empty(int(sizes.sum()), np.int64)
        ends = np.cumsum(sizes)
        for k, (which, token) in enumerate(steps):
            tokens[ends[which] - 1 - k] = token
        owner = np.repeat(doc, sizes)
        return self._spell(tokens, owner, len(texts))

    def _spell(self, tokens: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Put byte ids in place of the characters that are no piece."""
        at = np.flatnonzero(tokens < 0)
        if len(at):
            codes = -1 - tokens[at]
            codes = np.where(codes >= _RAW, codes - _RAW, codes)
            values, which = np.unique(codes, return_inverse=True)
            spelled = [self.vocabulary.byte_id[list(chr(c).encode("utf-8", "surrogatepass"))] for c in values.tolist()]
            width = np.ones(len(tokens), np.int64)
            width[at] = np.array([len(s) for s in spelled])[which]
            out = np.repeat(tokens, width)
            starts = (np.cumsum(width) - width)[at]
            for n in range(1, 5):
                long = np.flatnonzero(width[at] >= n)
                column = np.array([s[n - 1] if len(s) >= n else -1 for s in spelled])
                out[starts[long] + n - 1] = column[which[long]]
            tokens, owner = out, np.repeat(owner, width)
        return tokens.astype(np.int32), np.bincount(owner, minlength=texts)


def _codes(text: str) -> np.ndarray:
    """Code points as pieces write them."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    return np.where(codes == _SPACE, _RAW + _SPACE, np.where(codes == 32, _SPACE, codes))


def _encoder(path: str, theta: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = kept("sentence pieces", f"pieces:{path}", lambda: Vocabulary(path))
        lattices: Lattices = kept("sentence pieces", f"lattices:{path}:{theta}", lambda: Lattices(vocabulary, theta))
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for at, texts in column_batches(batch.column("text"), _BATCH_CHARS):
                ids, counts = lattices.sample(texts, keys[at : at + len(texts)])
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(at, len(texts)), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))],
                    ["row", "ids"],
                )

    return run


def encode(
    docs: DataFrame, path: str, theta: float = THETA, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", out: str = "ids"
) -> DataFrame:
    """Add a sampled segmentation of every whole text, seeded by the row's id.

    A larger ``theta`` favours the model's own segmentation. Defined cases: a
    null or empty text has no ids; a null id is a key like any other; rows with
    the same id and text get the same ids; every row is kept; a column named
    ``out`` is replaced.
    """
    key = F.xxhash64(F.lit(seed), F.col(id_col).isNull(), F.col(id_col))
    packed = docs.select(F.struct("*").alias("row"), key.alias("key"), F.col(text_col).alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    done = packed.mapInArrow(_encoder(path, theta), f"row {kind}, ids array<int>")
    return done.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() != out.lower()], F.col("ids").alias(out))


def _digester(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = kept("sentence pieces", f"pieces:{path}", lambda: Vocabulary(path))
        for batch in batches:
            texts = [vocabulary.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "decoded"])

    return run


def decode(coded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of every segmentation. Null or no ids give the empty text; a column named ``out`` is replaced."""
    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    packed = coded.select(F.struct("*").alias("row"), ids.alias("ids"))
    kind = packed.schema["row"].dataType.simpleString()
    done = packed.mapInArrow(_digester(path), f"row {kind}, decoded string")
    return done.select(*[F.col("row")[c].alias(c) for c in coded.columns if c.lower() != out.lower()], F.col("decoded").alias(out))


def _coder(path: str, theta: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = kept("sentence pieces", f"pieces:{path}", lambda: Vocabulary(path))
        for batch in _encoder(path, theta)(batches):
            ids = batch.column("ids")
            flat, bounds = ids.values.to_numpy(), ids.offsets.to_numpy()
            digests = [hashlib.sha256(t).hexdigest() for t in vocabulary.decode_all(flat, np.diff(bounds))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], ["row", "ids", "decoded_sha256"])

    return run


def coded_documents(docs: DataFrame, path: str, theta: float = THETA, seed: int = 0) -> DataFrame:
    """Per document its sampled ids, their number, and the SHA-256 of the text decoded from them."""
    key = F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), F.col("doc_id"))
    packed = docs.select(F.col("doc_id").alias("row"), key.alias("key"), "text")
    done = packed.mapInArrow(_coder(path, theta), f"row {dict(docs.dtypes)['doc_id']}, ids array<int>, decoded_sha256 string")
    return done.select(F.col("row").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded_sha256")
