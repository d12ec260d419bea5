"""Cutting texts into units that a tokenizer can be asked about once each.

A boundary lies before a single space between two characters that are no white
space. Tokenizers that split before such a space give the same ids for a text
as for its units one after the other. Units repeat, so each is tokenized once
per task and looked up afterwards; Arrow cuts a batch of texts and finds its
distinct units, so only those become Python strings.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LATIN = "\u0250"  # letters before it are letters to every tokenizer
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")


def column_batches(texts: pa.Array, chars: int) -> Iterator[tuple[int, pa.Array]]:
    """Runs of a text column of about ``chars`` characters, with the place of the first."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        stop = min(int(np.searchsorted(ends, before + chars)) + 1, len(texts))
        yield at, texts.slice(at, stop - at)
        at = stop


class Units:
    """Numbers the units of texts; a subclass keeps what it learns of each unit by its number.

    All is forgotten once ``limit`` units, or more than a subclass may hold, are
    held, which bounds the memory; results do not depend on it.
    """

    # Marks that are units of their own where they end a part behind a letter.
    ends = ""

    def __init__(self, limit: int):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        # Keys: a plain string follows a space; (text, follows) begins a text, or belongs to one cut anew.
        self.numbers: dict[str | tuple[str, bool], int] = {}
        self.clean = np.zeros(0, bool)

    def full(self) -> bool:
        return len(self.clean) > self.limit

    def learn(self, strings: list[str], begins: bool, clean: np.ndarray) -> None:
        """Take in new units, which all begin their texts or all do not; the latter have their leading space.

        ``clean`` tells which have no white space at an end besides that.
        """
        raise NotImplementedError

    def _add(self, parts: list[str], begins: bool, cut_anew: bool = False) -> None:
        if parts:
            clean = _clean(parts)
            self.learn(parts if begins else [" " + p for p in parts], begins, clean)
            self.clean = np.concatenate([self.clean, clean | cut_anew])

    def units(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The unit numbers of all texts one after the other, and how many each text has; a null text is empty."""
        if self.full():
            self.forget()
        column = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        lists = pc.split_pattern(column, " ")
        bounds, parts = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
        bounds -= bounds[0]
        filled = pc.binary_length(column).to_numpy(zero_copy_only=False) > 0
        inner = np.ones(len(parts), bool)
        inner[bounds[:-1]] = False
        every, tails = np.empty(len(parts), np.int64), np.full(len(parts), -1, np.int64)
        every[inner], tails[inner] = self._placed(parts.filter(pa.array(inner)))
        begins = bounds[:-1][filled]
        every[begins] = self._numbered([(p, False) for p in _strings(parts.take(pa.array(begins)))])
        # An empty text has one empty part, which is no unit.
        kept = np.ones(len(parts), bool)
        kept[bounds[:-1][~filled]] = False
        every, tails, counts = every[kept], tails[kept], np.where(filled, np.diff(bounds), 0)
        # Texts in which a cut at every space is not a boundary are cut anew.
        unclean = np.flatnonzero(~self.clean[every])
        if len(unclean):
            at = np.concatenate([[0], np.cumsum(counts)])
            found, ends, done = [], [], 0
            for i in np.unique(np.searchsorted(at, unclean, side="right") - 1).tolist():
                cut = _BOUNDARY.split(column[i].as_py())
                own = self._numbered([(cut[0], False), *((p, True) for p in cut[1:])])
                found += [every[done : at[i]], own]
                ends += [tails[done : at[i]], np.full(len(own), -1)]
                done, counts[i] = at[i + 1], len(own)
            every, tails = np.concatenate([*found, every[done:]]), np.concatenate([*ends, tails[done:]])
        if self.ends:
            at = np.concatenate([[0], np.cumsum(counts)])
            behind = np.concatenate([[0], np.cumsum(tails >= 0)])
            counts += np.diff(behind[at])
            every = np.repeat(every, 1 + (tails >= 0))
            own = np.flatnonzero(tails >= 0)
            every[own + behind[own] + 1] = tails[own]
        return every, counts

    def _placed(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of parts that follow a space, and of the marks at their ends, -1 if there are none."""
        coded = parts.dictionary_encode()
        names, tails = coded.dictionary, np.full(len(coded.dictionary), -1, np.int64)
        if self.ends:
            bare = pc.utf8_rtrim(names, characters=self.ends)
            letter = pc.utf8_slice_codeunits(bare, -1)
            cut = pc.and_(pc.and_(pc.utf8_is_alpha(letter), pc.less(letter, _LATIN)), pc.not_equal(bare, names))
            marks = np.where(cut.to_numpy(zero_copy_only=False), pc.subtract(pc.utf8_length(names), pc.utf8_length(bare)).to_numpy(), 0)
            for n in np.unique(marks[marks > 0]).tolist():
                at = np.flatnonzero(marks == n)
                own = pc.utf8_slice_codeunits(names.take(pa.array(at)), -n).dictionary_encode()
                tails[at] = self._numbered([(t, False) for t in _strings(own.dictionary)])[own.indices.to_numpy()]
            again = pc.if_else(cut, bare, names).dictionary_encode()
            numbers = self._taken(_strings(again.dictionary))[again.indices.to_numpy()]
        else:
            numbers = self._taken(_strings(names))
        which = coded.indices.to_numpy()
        return numbers[which], tails[which]

    def _taken(self, strings: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.numbers.get, strings, repeat(-1)), np.int64, len(strings))
        fresh = np.flatnonzero(numbers < 0)
        new = list(map(strings.__getitem__, fresh.tolist()))
        numbers[fresh] = np.arange(len(self.clean), len(self.clean) + len(new))
        self.numbers.update(zip(new, numbers[fresh].tolist(), strict=True))
        self._add(new, False)
        return numbers

    def _numbered(self, keys: list[tuple[str, bool]]) -> np.ndarray:
        """The numbers of units of which the keys tell whether they follow a space."""
        new = [k for k in dict.fromkeys(keys) if k not in self.numbers]
        for follows in (False, True):
            own = [k for k in new if k[1] == follows]
            self.numbers.update(zip(own, range(len(self.clean), len(self.clean) + len(own)), strict=True))
            self._add([k[0] for k in own], not follows, cut_anew=follows)
        return np.fromiter(map(self.numbers.__getitem__, keys), np.int64, len(keys))


class UnitTable(Units):
    """Ids of units by number, from ``encode``, which takes strings and whether they begin with a boundary's space and end with no
    white space, so that they may stand beside others like them, and returns all their ids and how many each has."""

    def __init__(self, encode: Callable[[list[str], np.ndarray], tuple[np.ndarray, np.ndarray]], limit: int = 1_000_000, ends: str = ""):
        self.encode, self.ends = encode, ends
        super().__init__(limit)

    def forget(self) -> None:
        super().forget()
        self.lengths = self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def learn(self, strings: list[str], begins: bool, clean: np.ndarray) -> None:
        flat, lengths = self.encode(strings, clean & (not begins))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])

    def ids(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        every, counts = self.units(texts)
        lengths = self.lengths[every]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[every] - (ends - lengths), lengths)
        at += np.arange(total)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return self.flat[at], np.diff(bounds)


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _clean(parts: list[str]) -> np.ndarray:
    """Which parts are not empty and have no white space at an end."""
    column, out = pa.array(parts, pa.string()), np.ones(len(parts), bool)
    for ends in (pc.utf8_slice_codeunits(column, 0, 1), pc.utf8_slice_codeunits(column, -1)):
        coded = ends.dictionary_encode()
        out &= np.array([bool(c) and not c.isspace() for c in _strings(coded.dictionary)], bool)[coded.indices.to_numpy()]
    return out
