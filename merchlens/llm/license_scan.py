"""Licence scan: Dice coefficient of word bigrams against licence templates.

Texts and templates are normalised to lower-case letters and digits. A segment
is a line, a run of sentences of a line, or a run of neighbouring lines that
all share bigrams with templates; whole licence texts are looked for in windows
over the document. A notice counts for a template only if it names its version
and family, and of segments with common words only those that explain most
count, each with its best template. With Dice 2 * shared / (a + b) of at least t, the
smaller of a and b is at least t / (2 - t) times the larger, so templates of
other sizes are passed over before any comparison.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate
from pathlib import Path
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.worker import kept

THRESHOLD = 0.8

# Licence notices; whole texts lie in license_texts.
_NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("Apache", "Licensed under the Apache License."),
    ("MPL-1.1", 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License")'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    # Opens every BSD text, so it does not tell which.
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
        "it and redistribute it freely, subject to the following restrictions:",
    ),
)

_GNU = (
    ("GPL", "General Public License", ("1", "2", "3")),
    ("LGPL", "Library General Public License", ("2",)),
    ("LGPL", "Lesser General Public License", ("2.1", "3")),
    ("AGPL", "Affero General Public License", ("1", "3")),
)
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}


def _gnu() -> Iterator[tuple[str, str]]:
    for family, title, versions in _GNU:
        yield family, f"Licensed under the GNU {title}."
        yield family, f"This work is licensed under the GNU {title}."
        for version in versions:
            name = f"{family}-{version}" if "." in version else f"{family}-{version}.0"
            for start in ("Licensed", "This work is licensed"):
                yield name, f"{start} under the GNU {title}, version {version}."
                yield name, f"{start} under the GNU {title} v{version}."
            for work in ("program", "library") if family == "LGPL" else ("program",):
                terms = (
                    f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {title} "
                    "as published by the Free Software Foundation"
                )
                yield name, f"{terms}, either version {version} of the License, or (at your option) any later version."
                yield name, f"{terms}, version {version} of the License."


def _creative_commons() -> Iterator[tuple[str, str]]:
    for code, title in _CC.items():
        for version, where in _CC_VERSIONS.items():
            yield f"CC-{code}-{version}", f"Licensed under CC {code} {version}."
            yield f"CC-{code}-{version}", f"This work is licensed under a Creative Commons {title} {version} {where} License."


TEMPLATES = (*_NOTICES, *_gnu(), *_creative_commons())
# Families whose version is not stated.
UNVERSIONED = frozenset({"Apache", "BSD", "GPL", "LGPL", "AGPL"})


def whole_texts() -> tuple[tuple[str, str], ...]:
    """Names and whole texts of licences."""
    folder = Path(__file__).parent / "license_texts"
    return tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted(folder.glob("*.txt")))


_WORD = re.compile(r"[a-z0-9]+")
_SENTENCE = re.compile(r"(?<=[.!?;:])\s+")


def bigrams(text: str) -> list[tuple[str, str]]:
    words = _WORD.findall(text.lower())
    return list(zip(words, words[1:]))


def dice(a: Counter, n: int, b: Counter, m: int) -> float:
    """Dice coefficient of two bags of n and m bigrams."""
    return 2 * sum(min(k, b[g]) for g, k in a.items() if g in b) / (n + m)


# Words that tell licences of a family apart, in the ways they are written.
_GNU_MARKS = {"lesser": "lesser", "library": "library", "affero": "affero"}
_CC_MARKS = {
    "sa": "sa", "sharealike": "sa", "alike": "sa", "nc": "nc", "noncommercial": "nc", "commercial": "nc",
    "nd": "nd", "noderivatives": "nd", "noderivs": "nd", "derivatives": "nd", "derivs": "nd",
}
_VERSION = re.compile(r"v?([1-9])")


class Marks(NamedTuple):
    """What a notice says of version and family; families are read only where a text names them."""

    numbers: frozenset[str]
    gnu: frozenset[str] | None
    cc: frozenset[str] | None

    @classmethod
    def of(cls, grams: Sequence[tuple[str, str]]) -> Marks:
        words = {w for g in grams for w in g}
        return cls(
            frozenset(m[1] for m in map(_VERSION.fullmatch, words) if m),
            # "this library" is the work, not the licence.
            frozenset(k for a, b in grams for w, k in _GNU_MARKS.items() if w == a and b == "general") if "gnu" in words else None,
            frozenset(_CC_MARKS[w] for w in words & _CC_MARKS.keys()) if words & {"cc", "creative"} else None,
        )

    def allow(self, found: Marks) -> bool:
        """Whether a segment with ``found`` can be this template: its version is there, its family the same."""
        return (
            self.numbers <= found.numbers
            and (self.gnu is None or self.gnu == found.gnu)
            and (self.cc is None or self.cc == found.cc)
        )


class Found(NamedTuple):
    """A stretch of words [start, stop) that is like a template; ``gain`` is bigrams shared less bigrams not shared."""

    start: int
    stop: int
    gain: float
    score: float
    name: str


def _best_apart(found: Iterable[Found]) -> list[Found]:
    """The stretches without common words that gain most together."""
    best: dict[tuple[int, int], Found] = {}
    for f in found:
        old = best.get(f[:2])
        if old is None or (-f.gain, f.name) < (-old.gain, old.name):
            best[f[:2]] = f
    ordered = sorted(best.values(), key=lambda f: (f.stop, f.start))
    stops = [f.stop for f in ordered]
    total, take = [0.0], []
    for i, f in enumerate(ordered):
        before = bisect_right(stops, f.start, 0, i)
        take.append((total[before] + f.gain > total[-1], before))
        total.append(max(total[-1], total[before] + f.gain))
    out, i = [], len(ordered)
    while i:
        taken, before = take[i - 1]
        if taken:
            out.append(ordered[i - 1])
        i = before if taken else i - 1
    return out[::-1]


class Scanner:
    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD, texts=None):
        self.threshold = threshold
        bags = [(name, bigrams(text)) for name, text in templates]
        self.bags = sorted(((len(g), name, Counter(g), Marks.of(g)) for name, g in bags if g), key=lambda x: (x[0], x[1]))
        self.sizes = [n for n, *_ in self.bags]
        self.known = frozenset(g for _, _, bag, _ in self.bags for g in bag)
        self.bound = threshold / (2 - threshold)
        whole = [(name, Counter(bigrams(text))) for name, text in (whole_texts() if texts is None else texts)]
        self.whole = [(sum(bag.values()), name, bag) for name, bag in whole]
        # The whole texts that have a bigram, and how often.
        self.holders: dict[tuple[str, str], list[tuple[int, int]]] = {}
        for i, (_, _, bag) in enumerate(self.whole):
            for g, k in bag.items():
                self.holders.setdefault(g, []).append((i, k))

    def _alike(self, grams: Sequence[tuple[str, str]]) -> Iterator[tuple[float, int, str, Marks]]:
        n = len(grams)
        # A little wider than the bounds, so that rounding excludes none; Dice decides.
        low = bisect_left(self.sizes, n * self.bound - 1e-9)
        high = bisect_right(self.sizes, n / self.bound + 1e-9)
        bag = Counter(grams) if low < high else None
        for m, name, template, marks in self.bags[low:high]:
            found = dice(bag, n, template, m)
            if found >= self.threshold:
                yield found, m, name, marks

    def matches(self, grams: list[tuple[str, str]]) -> Iterator[tuple[float, str]]:
        """Templates that a segment is like enough, of those whose size allows it."""
        for found, _, name, _ in self._alike(grams):
            yield found, name

    def segments(self, text: str) -> tuple[list[tuple[str, str]], list[tuple[int, int]]]:
        """The bigrams of a text, and the stretches [start, stop) of words that can be like a template.

        A segment that is like enough shares at least ``bound`` of its own bigrams; others are left out.
        """
        words: list[str] = []
        lines = []
        for line in text.split("\n"):
            start = len(words)
            words += _WORD.findall(line.lower())
            lines.append((start, len(words), line))
        grams = list(zip(words, words[1:]))
        known = list(accumulate(map(self.known.__contains__, grams), initial=0))
        most = self.sizes[-1] / self.bound + 1
        out: list[tuple[int, int]] = []

        def has(a: int, b: int) -> bool:
            return b - a > 1 and known[b - 1] > known[a]

        def add(a: int, b: int) -> None:
            if b - a > 1 and known[b - 1] - known[a] >= self.bound * (b - a - 1) - 1e-9:
                out.append((a, b))

        def stretches(run: list[tuple[int, int]]) -> None:
            """Neighbours together, up to the size of the longest template allowed."""
            for i, (a, _) in enumerate(run):
                for _, b in run[i + 1 :]:
                    if b - a - 1 > most:
                        break
                    add(a, b)

        run: list[tuple[int, int]] = []
        for start, stop, line in lines:
            if has(start, stop):
                add(start, stop)
                parts = _SENTENCE.split(line)
                if len(parts) > 1:
                    ends = list(accumulate((len(_WORD.findall(p.lower())) for p in parts), initial=start))
                    spans = list(zip(ends, ends[1:]))
                    for a, b in spans:
                        add(a, b)
                    stretches(spans)
                run.append((start, stop))
            elif line.strip():
                stretches(run)
                run = []
        stretches(run)
        return grams, list(dict.fromkeys(out))

    def scan(self, text: str) -> dict[str, float]:
        """Every licence that has a notice like any segment, each with its highest coefficient."""
        found: dict[str, float] = {}
        grams, spans = self.segments(text)
        for a, b in spans:
            for score, name in self.matches(grams[a : b - 1]):
                found[name] = max(found.get(name, 0.0), score)
        return found

    def licenses(self, text: str) -> dict[str, float]:
        """The licences of a text, each with its highest coefficient.

        Of stretches with common words, only those that together explain most
        count, each with its best template; a template whose version or family
        a notice does not name is passed over.
        """
        grams, spans = self.segments(text)
        found = [*self._notices(grams, spans), *self._whole(grams)]
        out: dict[str, float] = {}
        for f in _best_apart(found):
            out[f.name] = max(out.get(f.name, 0.0), f.score)
        return out

    def _notices(self, grams: list[tuple[str, str]], spans: list[tuple[int, int]]) -> Iterator[Found]:
        for a, b in spans:
            own = grams[a : b - 1]
            said = None
            for score, m, name, marks in self._alike(own):
                said = said or Marks.of(own)
                if marks.allow(said):
                    gain = (1.5 * score - 1) * (len(own) + m)
                    # Any version that is named comes before the family alone.
                    yield Found(a, b, gain / 2 if name in UNVERSIONED else gain, score, name)

    def _whole(self, grams: list[tuple[str, str]]) -> Iterator[Found]:
        """Stretches like a whole licence text; only texts of which enough bigrams are there are looked for."""
        here = Counter(filter(self.holders.__contains__, grams))
        have = [0] * len(self.whole)
        for g, k in here.items():
            for i, most in self.holders[g]:
                have[i] += min(k, most)
        for i, (m, name, bag) in enumerate(self.whole):
            # As for segments: Dice of at least t needs t / (2 - t) of the template.
            if have[i] >= self.bound * m - 1e-9:
                yield from self._placed(grams, m, name, bag)

    def _placed(self, grams: list[tuple[str, str]], m: int, name: str, bag: Counter) -> Iterator[Found]:
        """The best windows of each width, a twentieth apart, cut at both ends to bigrams of the template."""
        steps = range(-8, 9)
        for width in sorted({min(len(grams), max(1, round(m * 1.05**k))) for k in steps}):
            inside: Counter = Counter()
            shared, over = 0, []
            for at, g in enumerate(grams):
                if g in bag:
                    shared += inside[g] < bag[g]
                    inside[g] += 1
                if at >= width:
                    gone = grams[at - width]
                    if gone in bag:
                        shared -= inside[gone] <= bag[gone]
                        inside[gone] -= 1
                if at >= width - 1 and 2 * shared >= self.threshold * (width + m):
                    over.append((-shared, at - width + 1))
            # The best first; of those with common bigrams only the first.
            taken: list[int] = []
            for _, a in sorted(over):
                k = bisect_left(taken, a)
                if (k and taken[k - 1] + width > a) or (k < len(taken) and a + width > taken[k]):
                    continue
                taken.insert(k, a)
            for a in taken:
                b = a + width
                while grams[a] not in bag:
                    a += 1
                while grams[b - 1] not in bag:
                    b -= 1
                score = dice(Counter(grams[a:b]), b - a, bag, m)
                yield Found(a, b + 1, (1.5 * score - 1) * (b - a + m), score, name)


def _scan(threshold: float, texts: tuple[tuple[str, str], ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept("licenses", f"licenses:{threshold}", lambda: Scanner(threshold=threshold, texts=texts))
        for batch in batches:
            found = [scanner.licenses(t or "") for t in batch.column("text").to_pylist()]
            # The best first; equal ones by name.
            ranked = [sorted(f.items(), key=lambda x: (-x[1], x[0])) for f in found]
            names = pa.array([[n for n, _ in r] for r in ranked], pa.list_(pa.string()))
            scores = pa.array([[s for _, s in r] for r in ranked], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), names, scores], ["row", "licenses", "scores"])

    return run


def with_licenses(docs: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Add ``licenses`` (names, best first, equal ones by name) and their ``scores`` to every document.

    Whole texts are scanned; a null or empty text has none. Every row is kept;
    columns with those two names are replaced.
    """
    packed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    done = packed.mapInArrow(_scan(threshold, whole_texts()), f"row {kind}, licenses array<string>, scores array<double>")
    made = ("licenses", "scores")
    return done.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in made], *made)


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: its best licence, if any, with the coefficient, how many were found, and all with theirs."""
    return with_licenses(docs.select("doc_id", "text")).select(
        "doc_id",
        F.get("licenses", F.lit(0)).alias("license"),
        F.get("scores", F.lit(0)).alias("dice"),
        F.size("licenses").cast("bigint").alias("n_licenses"),
        "licenses",
        "scores",
    )
