"""PartEnum signatures: sets similar enough share one, whatever else differs.

For sets r and s with Jaccard likeness of at least t, the symmetric difference
has at most k = (1 - t) / (1 + t) * (|r| + |s|) elements. Sets of one band of
sizes share a partition of the hash range into n1 parts, each cut into n2
pieces. If more than k / 2 parts are looked at, some part holds at most one
differing element, so r and s agree there on all pieces but one. Hence every
part gives n2 signatures, each of the part without one of its pieces, and r and
s share a signature.

A signature of no element says nothing and would be shared by many sets. A part
is *solid* for r if none of its n2 signatures is empty. r gives the non-empty
signatures of its first parts, up to the one at which more than k / 2 of them
are solid. Of two similar sets, take the one that stops first: among its solid
parts one has at most one difference, and the signature agreed on there is not
empty, so the other set gives it too. A set that has too few solid parts gives
all signatures, empty ones as well; if both sets are like that, they share one.
"""

from __future__ import annotations

import numpy as np

from merchlens.llm.word_sets import _STEP, mix

_U = np.uint64


class Bands:
    """Bands of set sizes and their partitions for likeness of at least num / den."""

    def __init__(self, num: int = 80, den: int = 100, first: int = 1, growth: float = 1.5):
        self.num, self.den, self.growth, self.first = num, den, growth, first
        self._bands: list[tuple[int, int, int, int]] = []
        self._tags: dict[int, list[tuple[int, int]]] = {}

    def differ(self, total: int) -> int:
        """The most elements in which two similar sets of ``total`` elements together differ."""
        return (self.den - self.num) * total // (self.den + self.num)

    def largest_partner(self, n: int) -> int:
        return n * self.den // self.num

    def band(self, i: int) -> tuple[int, int, int, int]:
        """Band i as (smallest size, largest size, parts, pieces of a part)."""
        while len(self._bands) <= i:
            low = self._bands[-1][1] + 1 if self._bands else self.first
            high = max(low + 1, int(low * self.growth)) - 1
            need = self.differ(high + self.largest_partner(high)) // 2 + 1
            parts = need if need == 1 else int(need * 1.15) + 1
            self._bands.append((low, high, parts, 3 if need > 4 else 6))
        return self._bands[i]

    def of(self, n: int) -> int:
        i = 0
        while self.band(i)[1] < n:
            i += 1
        return i

    def tags(self, n: int) -> list[tuple[int, int]]:
        """The bands in which a set of n elements gives signatures, each with its greatest k.

        That is its own band, for partners in it and larger ones of the next,
        and lower bands if they hold sets that are similar to this larger one.
        """
        if n not in self._tags:
            own = self.of(n)
            out = [(own, self.differ(n + self.largest_partner(n)))]
            i = own - 1
            while i >= 0 and self.largest_partner(self.band(i)[1]) >= n:
                out.append((i, self.differ(n + self.band(i)[1])))
                i -= 1
            self._tags[n] = out
        return self._tags[n]


def signatures(s: np.ndarray, bands: Bands) -> np.ndarray:
    """The PartEnum signatures of a set of 64-bit hashes; none for a set that only an equal one resembles."""
    tags = bands.tags(len(s)) if len(s) else []
    if not tags or tags[0][1] == 0:
        return np.zeros(0, np.int64)  # similar only to an equal set
    out, mixed = [], mix(s)
    for tag, k in tags:
        _, _, parts, pieces = bands.band(tag)
        cells = parts * pieces
        cell = ((s >> _U(32)) * _U(cells) >> _U(32)).astype(np.int64)
        counts = np.bincount(cell, minlength=cells).reshape(parts, pieces)
        sums = np.zeros(cells, np.uint64)
        # The hashes are sorted, so each cell is one run of them.
        full = np.flatnonzero(counts.ravel())
        sums[full] = np.add.reduceat(mixed, np.cumsum(counts)[full] - counts.ravel()[full])
        sums = sums.reshape(parts, pieces)
        left = sums.sum(axis=1, keepdims=True, dtype=np.uint64) - sums
        size = counts.sum(axis=1, keepdims=True) - counts
        solid = np.cumsum((size > 0).all(axis=1))
        need = k // 2 + 1
        if solid[-1] >= need:
            stop = int(np.searchsorted(solid, need)) + 1
            chosen = size[:stop] > 0
        else:
            stop, chosen = parts, np.ones((parts, pieces), bool)
        place = (np.arange(stop * pieces, dtype=np.uint64) + _U(tag << 40)).reshape(stop, pieces)
        out.append((mix(left[:stop]) ^ mix(place * _STEP))[chosen])
    return mix(np.concatenate(out)).astype(np.int64)


def profile(s: np.ndarray) -> bytes:
    """A bitmap of the cells that a set's hashes fall into: two to four cells for each, by their lowest bits."""
    cells = max(64, 2 << max(2 * len(s) - 1, 1).bit_length())
    bits = np.zeros(cells, np.uint8)
    bits[(s & _U(cells - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(table: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) brought to fewer cells, as if made with so many."""
    while table.shape[1] > words:
        half = table.shape[1] // 2
        table = table[:, :half] | table[:, half:]
    return table


def with_possible_partner(profiles: list[bytes], sizes: np.ndarray, label: np.ndarray, bands: Bands) -> np.ndarray:
    """Which of some sets may be similar to one of them with another label.

    False only for a set that is similar to none: a cell that one bitmap has and
    the other has not holds an element that one set has and the other has not.
    """
    words = np.array([len(p) // 8 for p in profiles])
    out = np.zeros(len(profiles), bool)
    for width in np.unique(words):
        # Similar sets differ in size by less than a factor of two, so their bitmaps have one width or neighbouring ones.
        narrow = np.flatnonzero(words == width)
        others = np.flatnonzero((words == width) | (words == 2 * width))
        table = np.empty((len(others), width), np.uint64)
        for w in (width, 2 * width):
            at = np.flatnonzero(words[others] == w)
            if len(at):
                table[at] = folded(np.frombuffer(b"".join(profiles[i] for i in others[at]), np.uint64).reshape(len(at), -1), int(width))
        place = np.searchsorted(others, narrow)
        for i, k in zip(narrow, place, strict=True):
            fits = np.flatnonzero(
                (label[others] != label[i])
                & (bands.den * np.minimum(sizes[others], sizes[i]) >= bands.num * np.maximum(sizes[others], sizes[i]))
                & ~(out[others] & out[i])
            )
            if not len(fits):
                continue
            apart = np.bitwise_count(table[fits] ^ table[k]).sum(axis=1, dtype=np.int64)
            near = fits[apart <= (bands.den - bands.num) * (sizes[others[fits]] + sizes[i]) // (bands.den + bands.num)]
            if len(near):
                out[others[near]] = out[i] = True
    return out
