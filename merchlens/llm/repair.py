"""Re-Pair grammar compression of token ids, and its shard format.

Frequent pairs of neighbouring symbols are replaced by new symbols, round after
round, as long as pairs are frequent. A shard holds the rules, how many ids
each rule stands for, the documents' lengths in symbols and ids, and the final
sequence; so any document, or any range of ids, can be read without the rest.

Layout, little-endian: the magic ``RPG1``; uint32 first nonterminal, rules,
documents, bytes of a symbol (2 or 4); uint64 symbols, ids; then the arrays
rules (two symbols each, uint32), expansion lengths (uint32), symbols per
document (uint64), ids per document (uint64), and the sequence.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_HEAD = "<4sIIIIQQ"
_BINS = 20  # log2 of the bins in which pairs are counted first
_ROUND_PAIRS = 1024  # pairs replaced in one round at most
ROUNDS = 6
# A pair is frequent if it makes up at least this share of the ids, and occurs 8 times.
MIN_SHARE = 1 / 8192


def _frequent(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent pair codes in ascending order, and the positions of pairs in their bins."""
    bins = codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bins >>= np.uint64(64 - _BINS)
    bins = bins.view(np.int64)
    counts = np.bincount(bins, minlength=1 << _BINS)
    hot = np.flatnonzero(counts >= least)
    if len(hot) > _ROUND_PAIRS:
        hot = hot[np.argsort(-counts[hot], kind="stable")[:_ROUND_PAIRS]]
    chosen = np.zeros(1 << _BINS, bool)
    chosen[hot] = True
    at = np.flatnonzero(chosen[bins])
    values, count = np.unique(codes[at], return_counts=True)
    return values[count >= least], at


def compress(ids: np.ndarray, lengths: np.ndarray, first: int, rounds: int = ROUNDS, min_share: float = MIN_SHARE):
    """Rules (n x 2), the symbol sequence, and the symbols of each document.

    ``lengths`` are the ids of each document; pairs do not cross documents.
    Each round replaces its frequent pairs from left to right. ``first`` is the
    first nonterminal; all ids are below it.
    """
    symbols = ids.astype(np.int32)
    filled = lengths > 0
    last = np.zeros(len(symbols), bool)
    last[np.cumsum(lengths)[filled] - 1] = True
    rules = np.zeros((0, 2), np.int64)
    least = max(8, int(len(ids) * min_share))
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        top = first + len(rules)
        codes = symbols[:-1] * np.int64(top)
        codes += symbols[1:]
        codes[last[:-1]] = -1
        pairs, at = _frequent(codes, least)
        pairs = pairs[pairs >= 0]
        if not len(pairs):
            break
        rank = pc.index_in(pa.array(codes[at]), pa.array(pairs)).fill_null(-1).to_numpy()
        hit = rank >= 0
        at, rank = at[hit], rank[hit]
        # Overlapping pairs follow each other; in each run of them every other one is taken.
        starts = np.concatenate([[True], np.diff(at) != 1])
        run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - run) % 2 == 0
        at, rank = at[taken], rank[taken]
        symbols[at] = top + rank
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last = symbols[keep], last[keep]
        rules = np.concatenate([rules, np.stack([pairs // top, pairs % top], axis=1)])
    counts = np.zeros(len(lengths), np.int64)
    counts[filled] = np.diff(np.concatenate([[-1], np.flatnonzero(last)]))
    return rules, symbols, counts


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule stands for; a rule uses earlier rules only."""
    out = np.ones(len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        out[i] = (out[a - first] if a >= first else 1) + (out[b - first] if b >= first else 1)
    return out


def pack(ids: np.ndarray, lengths: np.ndarray, first: int, **how) -> bytes:
    rules, symbols, counts = compress(ids, lengths, first, **how)
    width = 2 if first + len(rules) <= 1 << 16 else 4
    head = struct.pack(_HEAD, b"RPG1", first, len(rules), len(lengths), width, len(symbols), len(ids))
    return b"".join(
        [head, rules.astype("<u4").tobytes(), expansion_lengths(rules, first).astype("<u4").tobytes(),
         counts.astype("<u8").tobytes(), lengths.astype("<u8").tobytes(), symbols.astype(f"<u{width}").tobytes()]
    )


class Shard:
    """Reads a packed shard, whole or in part."""

    def __init__(self, data: bytes):
        magic, self.first, rules, docs, width, symbols, self.n_ids = struct.unpack_from(_HEAD, data)
        if magic != b"RPG1":
            raise ValueError("not a shard of token ids")
        at = struct.calcsize(_HEAD)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.rules = take("<u4", 2 * rules).reshape(-1, 2).astype(np.int64)
        spans = take("<u4", rules).astype(np.int64)
        self.symbol_counts, self.id_counts = take("<u8", docs).astype(np.int64), take("<u8", docs).astype(np.int64)
        self.symbols = take(f"<u{width}", symbols)
        # Every symbol's expansion, flat: ids stand for themselves.
        self.spans = np.concatenate([np.ones(self.first, np.int64), spans])
        self.at = np.cumsum(self.spans) - self.spans
        self.flat = np.empty(int(self.spans.sum()), np.uint32)
        self.flat[: self.first] = np.arange(self.first, dtype=np.uint32)
        for i, (a, b) in enumerate(self.rules.tolist()):
            s = self.first + i
            middle = self.at[s] + self.spans[a]
            self.flat[self.at[s] : middle] = self.flat[self.at[a] : self.at[a] + self.spans[a]]
            self.flat[middle : self.at[s] + self.spans[s]] = self.flat[self.at[b] : self.at[b] + self.spans[b]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        spans = self.spans[symbols]
        ends = np.cumsum(spans)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total, dtype=np.int64) + np.repeat(self.at[symbols] - (ends - spans), spans)]

    def document(self, i: int) -> np.ndarray:
        """The ids of document i; only its own symbols are expanded."""
        start = int(self.symbol_counts[:i].sum())
        return self.expand(self.symbols[start : start + int(self.symbol_counts[i])])

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids at [start, stop) of the shard; only the symbols that cover them are expanded."""
        start, stop = max(start, 0), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        ends = np.cumsum(self.spans[self.symbols])
        a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, stop, side="left")) + 1
        before = int(ends[a - 1]) if a else 0
        return self.expand(self.symbols[a:b])[start - before : stop - before]
