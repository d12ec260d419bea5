"""Word and shingle hashes of whole Arrow columns of texts, with numpy.

Used inside tasks: a column of texts is read as bytes, words are runs without
ASCII blanks, A-Z counts as a-z, and every word gets a 64-bit hash without any
Python string being made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are taken in runs of about this many bytes, which bounds the working memory.
_RUN_BYTES = 2 << 20
# Longer words are hashed one by one.
_LONG_WORD = 64

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = np.arange(256, dtype=np.uint64)
_BYTE[65:91] += _U(32)
_BYTE_HASH = mix(_BYTE + _STEP)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and each text's bounds; a null text is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def runs(bounds: np.ndarray, run_bytes: int = _RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Cut texts into runs [a, b) of about ``run_bytes``; a longer text is a run of its own."""
    a, count = 0, len(bounds) - 1
    while a < count:
        b = int(np.searchsorted(bounds, bounds[a] + run_bytes, side="right")) - 1
        b = min(max(b, a + 1), count)
        yield a, b
        a = b


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts data[bounds[i]:bounds[i+1]], and each text's bounds in them."""
    low, high = int(bounds[0]), int(bounds[-1])
    data, bounds = data[low:high], bounds - low
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    solid = ~_BLANK[data]
    before = np.ones(len(data), bool)
    before[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.ones(len(data), bool)
    after[:-1] = ~solid[1:]
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    at, by_length = starts[order], lengths[order]
    hashed = np.zeros(len(order), np.uint64)
    shorter = -by_length
    longest = min(int(by_length[0]), _LONG_WORD) if len(order) else 0
    with np.errstate(over="ignore"):
        for j in range(longest):
            live = int(np.searchsorted(shorter, -j, side="left"))
            part = hashed[:live]
            part *= _STEP
            part += _BYTE_HASH[data[at[:live] + j]]
        for k in range(int(np.searchsorted(shorter, -_LONG_WORD, side="left"))):
            word = data[at[k] : at[k] + by_length[k]].tobytes().lower()
            hashed[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        hashed += by_length.astype(np.uint64)
    out = np.empty_like(hashed)
    out[order] = mix(hashed)
    return out, np.searchsorted(starts, bounds)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order.

    A text with fewer words than a shingle has its whole sequence as one; a
    text without words has none.
    """
    data, bounds = text_bytes(column)
    weights = mix(np.arange(1, words + 1, dtype=np.uint64) * _STEP) | _U(1)
    for a, b in runs(bounds):
        hashes, at = word_hashes(data, bounds[a : b + 1])
        full = max(len(hashes) - words + 1, 0)
        with np.errstate(over="ignore"):
            joined = np.zeros(full, np.uint64)
            for j in range(words):
                joined += hashes[j : j + full] * weights[j]
            joined = mix(joined)
            for i in range(b - a):
                n = int(at[i + 1] - at[i])
                if n >= words:
                    yield np.unique(joined[at[i] : at[i + 1] - words + 1])
                elif n:
                    own = hashes[at[i] : at[i + 1]]
                    yield mix(np.array([(own * weights[:n]).sum(dtype=np.uint64) + _U(n)], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)


def set_key(s: np.ndarray) -> int:
    """A 64-bit number that stands for a set of hashes."""
    with np.errstate(over="ignore"):
        total = mix(s + _STEP).sum(dtype=np.uint64) * _STEP + _U(len(s))
    return int(mix(np.array([total], np.uint64)).astype(np.int64)[0])
