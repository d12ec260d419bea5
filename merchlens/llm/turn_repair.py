"""Repair of the structure of conversations by depth-first branch and bound.

A conversation's rows are kept (cost 0), given another role (2) or deleted (3;
blank rows and repeats must be), turns without text are inserted (2), and a
truncated row that stays adds 1, so that the roles become nothing or an optional
system turn and then user and assistant in turns. Of the cheapest ways the one
whose audit (initials of the edits) is least is taken.

The search keeps an explicit stack of prefixes. A node is a place before a row
and the last role put out. A prefix goes no further if a table of the node
holds one that is no worse, or if its cost and a lower bound of what the rest
must cost reach the incumbent's (at equal cost: if its audit is past the
incumbent's). The bound counts each row's least cost and two for every disjoint
pair of neighbours with one role, since one of them or the gap must be edited.

A conversation may be of any length. Rows are numbered in one global order and
worked on in blocks of neighbours. What a block cuts is searched for every role
before and after it, in stretches of bounded length, and the stretches' costs
and audits are put together like a product of matrices: two prefixes of equal
cost over the same rows are never one the beginning of the other, so the least
audit of the whole is made of least audits of its stretches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.line_dedup import BLANKS
from merchlens.llm.merkle import digest_of
from merchlens.llm.runs import runs
from merchlens.operators.ranking import with_rank

BLOCK_BITS = 10
STRETCH = 24
_KNOWN = 1 << 16  # searches a worker remembers

# Last role put out: nothing, system, user, assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
_WANTED = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_FOLLOWS = {(NONE, SYSTEM), (NONE, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
# Which last roles can follow which over a stretch.
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
LEGAL = {"su", "ua", "au"}
_FAR = 1 << 60

Way = tuple[int, str]  # cost and audit


def _bounds(rows: str) -> tuple[list[int], list[int], list[int]]:
    """Lower bounds of what rows from each place on cost: at least; if the next row that can
    stay must not keep its role; and that row's role.

    A row is the initial of its role (``o`` for any other), upper case if truncated, ``x`` if it must go.
    """
    n = len(rows)
    least = [3 if r == "x" else (min(3, 2 + r.isupper()) if r in "oO" else int(r.isupper())) for r in rows]
    rest, clash, role = [0] * (n + 2), [0] * (n + 2), [0] * (n + 2)
    for i in range(n - 1, -1, -1):
        rest[i] = least[i] + rest[i + 1]
        if rows[i] == "x":
            # Passed over: the next row that can stay is the one behind.
            clash[i], role[i] = least[i] + clash[i + 1], role[i + 1]
            continue
        role[i] = _INITIAL.get(rows[i].lower(), 0)
        clash[i] = least[i] + 2 + rest[i + 1]
        if role[i] in (USER, ASSISTANT) and role[i] == role[i + 1]:
            rest[i] = max(rest[i], least[i] + clash[i + 1])
    return rest, clash, role


def search(rows: str, start: int, end: int) -> Way | None:
    """The cheapest edits, and of these those with the least audit, that lead from one last role to another; None if none do."""
    n = len(rows)
    rest, clash, role = _bounds(rows)

    def bound(i: int, q: int) -> int:
        if end < USER:
            # Nothing, or one system row, may be put out: all others go.
            return 3 * (n - i - (q < end)) if q <= end and (i < n or q == end) else _FAR
        if i == n:
            return 0 if q == end else 2 * (1 + (end == ASSISTANT and q < USER))
        return clash[i] if q >= USER and role[i] == q else rest[i]

    best: Way | None = None
    table: dict[tuple[int, int], Way] = {(0, start): (0, "")}
    stack = [(0, start, 0, "")]
    while stack:
        i, q, cost, audit = stack.pop()
        if table[i, q] != (cost, audit):
            continue  # a better prefix has come here since
        low = cost + bound(i, q)
        if low >= _FAR or (best and (low > best[0] or (low == best[0] and audit > best[1][: len(audit)]))):
            continue
        if i == n and q == end:
            if best is None or (cost, audit) < best:
                best = (cost, audit)
            continue
        wanted = _WANTED[q]
        ways = [(i, wanted, cost + 2, audit + "I")]
        if i < n:
            r = rows[i]
            ways.append((i + 1, q, cost + 3, audit + "D"))
            if r != "x":
                extra = r.isupper()
                ways.append((i + 1, wanted, cost + 2 + extra, audit + "R"))
                own = _INITIAL.get(r.lower())
                if (q, own) in _FOLLOWS:
                    ways.append((i + 1, own, cost + extra, audit + "K"))
        # The last is taken first: that with the least bound, then audit.
        for i2, q2, cost2, audit2 in sorted(ways, key=lambda w: (w[2] + bound(w[0], w[1]), w[3]), reverse=True):
            known = table.get((i2, q2))
            if known is None or (cost2, audit2) < known:
                table[i2, q2] = (cost2, audit2)
                stack.append((i2, q2, cost2, audit2))
    return best


def _stretch_ways(found: Callable, rows: str, start: int) -> dict[int, Way]:
    ways = {end: found(rows, start, end) for s, end in PAIRS if s == start}
    return {end: way for end, way in ways.items() if way is not None}


def ways_through(found: Callable, rows: str, start: int) -> dict[int, Way]:
    """The cheapest way from ``start`` to every last role, over rows of any number, stretch by stretch."""
    now: dict[int, Way] = {start: (0, "")}
    for a in range(0, len(rows), STRETCH):
        after: dict[int, Way] = {}
        for q, (cost, audit) in now.items():
            for end, (more, edits) in _stretch_ways(found, rows[a : a + STRETCH], q).items():
                way = (cost + more, audit + edits)
                if end not in after or way < after[end]:
                    after[end] = way
        now = after
    return now


def _cheapest(ways: dict[int, Way]) -> Way:
    return min(ways[q] for q in (NONE, ASSISTANT) if q in ways)


# -- blocks ------------------------------------------------------------------

_RUN = (
    "no_conv long, conv long, at long, whole boolean, first string, last string, blank long, duplicate long, truncated long, "
    "illegal long, low long, high long, turns long, costs array<long>, audits array<string>"
)
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _blocks() -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lru_cache(_KNOWN)(search)
        schema = pa.schema(
            [("no_conv", pa.int64()), ("conv", pa.int64()), ("at", pa.int64()), ("whole", pa.bool_()), ("first", pa.string()), ("last", pa.string())]
            + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns")]
            + [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
        )
        for block in runs(batches, ["block"]):
            parts = list(runs(block.combine_chunks().to_batches(), ["no_conv", "conv"]))
            out = []
            for k, part in enumerate(parts):
                initials, faults = part.column("initial").to_pylist(), part.column("fault").to_pylist()
                turns = [t for t in part.column("turn").to_pylist() if t is not None]
                rows = "".join(
                    "x" if f in (1, 2) else (c.upper() if f == 3 else c)
                    for c, f in ((i if i in _INITIAL else "o", f) for i, f in zip(initials, faults, strict=True))
                )
                # Only the first and the last conversation of a block can go on in another.
                whole = 0 < k < len(parts) - 1
                if whole:
                    ways = [_cheapest(ways_through(found, rows, NONE))]
                else:
                    table = {s: ways_through(found, rows, s) for s in range(4)}
                    ways = [table[s].get(end, (_FAR, "")) for s, end in PAIRS]
                out.append(
                    {
                        "no_conv": part.column("no_conv")[0].as_py(), "conv": part.column("conv")[0].as_py(), "at": part.column("at")[0].as_py(),
                        "whole": whole, "first": initials[0], "last": initials[-1],
                        "blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3),
                        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
                        "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "turns": len(set(turns)),
                        "costs": [c for c, _ in ways], "audits": [a for _, a in ways],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _earlier(a: tuple, b: tuple) -> bool:
    """Whether the audit that ends in link ``a`` is less than that in ``b``; links are (link before, edits), equally many."""
    left, right = [], []
    while a is not b:
        left.append(a[1])
        right.append(b[1])
        a, b = a[0], b[0]
    return "".join(reversed(left)) < "".join(reversed(right))


class _Whole:
    """A conversation put together from its blocks' rows, in order."""

    def __init__(self, row: dict):
        self.key = (row["no_conv"], row["conv"])
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.low = self.high = self.last = None
        self.ways: dict[int, tuple[int, tuple]] = {NONE: (0, (None, ""))}
        self.done: Way | None = None

    def add(self, row: dict) -> None:
        for c in self.sums:
            self.sums[c] += row[c]
        if self.last is not None:
            self.sums["illegal"] += self.last + row["first"] not in LEGAL
        self.last = row["last"]
        if row["turns"]:
            if self.low is None:
                self.low = row["low"]
            self.sums["turns"] -= self.high == row["low"]
            self.high = row["high"]
        if row["whole"]:
            self.done = (row["costs"][0], row["audits"][0])
            return
        after: dict[int, tuple[int, tuple]] = {}
        for (start, end), more, edits in zip(PAIRS, row["costs"], row["audits"], strict=True):
            if start not in self.ways or more >= _FAR:
                continue
            cost, link = self.ways[start]
            way = (cost + more, (link, edits))
            known = after.get(end)
            if known is None or way[0] < known[0] or (way[0] == known[0] and _earlier(way[1], known[1])):
                after[end] = way
        self.ways = after

    def report(self) -> list:
        if self.done is None:
            ends = [self.ways[q] for q in (NONE, ASSISTANT) if q in self.ways]
            cost, link = ends[0]
            for other in ends[1:]:
                if other[0] < cost or (other[0] == cost and _earlier(other[1], link)):
                    cost, link = other
            edits = []
            while link[0] is not None:
                edits.append(link[1])
                link = link[0]
            self.done = (cost, "".join(reversed(edits)))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.sums["turns"]
        return [*self.key, gaps, *(self.sums[c] for c in ("blank", "duplicate", "truncated", "illegal")), *self.done]


def _joined() -> Callable:
    names = ["no_conv", "conv", *(c.split()[0] for c in _REPORT.split(", "))]

    def batch(rows: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Whole | None = None
        for rows in batches:
            done = []
            for row in rows.to_pylist():
                if now is None or now.key != (row["no_conv"], row["conv"]):
                    if now:
                        done.append(now.report())
                    now = _Whole(row)
                now.add(row)
            if done:
                yield batch(done)
        if now:
            yield batch([now.report()])

    return run


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    said = rows.select(
        F.col(conv).isNull().cast("bigint").alias("no_conv"),
        F.coalesce(F.col(conv).cast("bigint"), F.lit(0)).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    return said.withColumn("key", F.unhex(digest_of(F.col("no_conv"), F.col("conv"), F.col("role"), F.col("text"))))


_ORDER = ("no_conv", "conv", "turn", "role", "key")


def repairs(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """The faults of every conversation and its cheapest repair: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit).

    ``conv`` is named as ``conv_col``. Rows are taken by turn, nulls first; rows of one turn by role, then by the
    SHA-256 of role and text. Each row has one fault at most, the first of blank (nothing but blanks), duplicate (role
    and text seen earlier in the conversation) and truncated (the last character that is no blank is none of ``.!?``).
    ``illegal`` counts neighbours whose initials are not those of system and user, user and assistant, or assistant
    and user; ``gaps`` the turn numbers that are missing between the first and the last.

    Defined cases: a null role or text is one blank; rows without a conversation id are one conversation; repeated
    rows are duplicates; other columns are not read; an empty table gives none. A conversation of any length is worked
    on block by block; what is held of it is its audit, one character a row.
    """
    trimmed = F.btrim(F.col("text"), F.lit(BLANKS))
    light = _turns(turns, conv_col, turn_col, role_col, text_col).select(
        *_ORDER,
        F.substring("role", 1, 1).alias("initial"),
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        # Equal rows may lie in any order, but need not lie in one partition.
        F.monotonically_increasing_id().alias("number"),
    )
    ranked = with_rank(light, *[F.col(c) for c in _ORDER], F.col("number"), rank="at", total="all")
    # Only keys that occur again are joined, and their join splits hot ones.
    again = ranked.groupBy("key").agg(F.min("at").alias("seen"), F.count("*").alias("times")).filter("times > 1").select("key", "seen")
    fault = F.when(F.col("blank"), 1).when(F.col("at") > F.col("seen"), 2).when(F.col("cut"), 3).otherwise(0)
    rows = ranked.join(again, "key", "left").select(
        F.shiftright("at", block_bits).alias("block"), "at", "no_conv", "conv", "turn", "initial", fault.alias("fault")
    )
    parts = rows.repartition("block").sortWithinPartitions("block", "at").mapInArrow(_blocks(), _RUN)
    found = parts.repartition("no_conv", "conv").sortWithinPartitions("no_conv", "conv", "at").mapInArrow(
        _joined(), f"no_conv long, conv long, {_REPORT}"
    )
    return found.select(F.when(F.col("no_conv") == 0, F.col("conv")).alias(conv_col), *(c.split()[0] for c in _REPORT.split(", ")))


class _Applied:
    """The audit of one conversation applied to its rows as they come."""

    def __init__(self, key: tuple, report: list | None):
        self.key, self.report = key, report
        self.audit = report[-1] if report else ""
        self.at, self.last, self.lines = 0, NONE, 0
        self.digest = hashlib.sha256()

    def _out(self, state: int, role: str, text: str) -> tuple[str, str]:
        self.last = state
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1
        return role, text

    def inserted(self) -> list[tuple[str, str]]:
        out = []
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            state = _WANTED[self.last]
            out.append(self._out(state, _ROLE[state], ""))
        return out

    def row(self, role: str, text: str) -> list[tuple[str, str]]:
        out = self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            out.append(self._out(_INITIAL[role[0]], role, text))
        elif edit == "R":
            state = _WANTED[self.last]
            out.append(self._out(state, _ROLE[state], text))
        return out


def _applier(digest: bool) -> Callable:
    report = [c.split()[0] for c in _REPORT.split(", ")]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Applied, list, bool]]:
        """Each conversation with the turns put out next, and whether it ends here."""
        now: _Applied | None = None
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or now.key != (row["no_conv"], row["conv"]):
                    if now:
                        yield now, now.inserted(), True
                    now = _Applied((row["no_conv"], row["conv"]), [row[c] for c in report] if row["kind"] == 0 else None)
                if row["kind"] == 1:
                    yield now, now.row(row["role"], row["text"]), False
        if now:
            yield now, now.inserted(), True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        if digest:
            names = ["no_conv", "conv", *report, "repaired_sha256"]
            kinds = [pa.int64()] * (len(names) - 2) + [pa.string()] * 2
        else:
            names, kinds = ["no_conv", "conv", "place", "role", "text"], [pa.int64()] * 3 + [pa.string()] * 2
        for conv, turns, ended in whole(batches):
            if digest and ended:
                out.append((*conv.key, *(conv.report or [0] * 6 + [""]), conv.digest.hexdigest()))
            elif not digest:
                out += [(*conv.key, conv.lines - len(turns) + k, *t) for k, t in enumerate(turns)]
            if len(out) >= 2_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def _streams(turns: DataFrame, reports: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in order behind the report of their conversation; each conversation runs through one task as a stream."""
    key = [F.col(conv).isNull().cast("bigint").alias("no_conv"), F.coalesce(F.col(conv).cast("bigint"), F.lit(0)).alias("conv")]
    messages = reports.select(*key, *[c for c in reports.columns if c != conv], F.lit(0).alias("kind"))
    rows = _turns(turns, conv, turn, role, text).withColumn("kind", F.lit(1))
    both = rows.unionByName(messages, allowMissingColumns=True)
    return both.repartition("no_conv", "conv").sortWithinPartitions("no_conv", "conv", "kind", "turn", "role", "key").drop("key", "turn")


def repaired_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """The repaired conversations, one row a turn: (conv, place from 0, role, text). Cases are those of ``repairs``."""
    names = (conv_col, turn_col, role_col, text_col)
    rows = _streams(turns, repairs(turns, *names, block_bits), *names)
    found = rows.mapInArrow(_applier(digest=False), "no_conv long, conv long, place long, role string, text string")
    return found.select(F.when(F.col("no_conv") == 0, F.col("conv")).alias(conv_col), "place", F.col("role").alias(role_col), F.col("text").alias(text_col))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with some rows dropped, emptied, without sentence ends, repeated or said by the user, by a CRC-32 of
    conversation and turn (a null there is one blank)."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = conversations.select(
        "conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
        (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).alias("code"),
    )
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.filter("code != 0").select(
        "conv_id", "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def repair_digest(conversations: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Damage all conversations and repair them: faults, cost, audit and the SHA-256 of the repaired turns.

    The digest is a chain over a conversation's whole text, so each one streams through one task, a row at a time.
    """
    rows = damaged(conversations)
    names = ("conv_id", "turn", "role", "text")
    streams = _streams(rows, repairs(rows, block_bits=block_bits), *names)
    # Conversations of which no row is left come as a last kind of row, without a report before it.
    ids = conversations.select(
        F.col("conv_id").isNull().cast("bigint").alias("no_conv"), F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv")
    ).distinct()
    lost = ids.join(
        rows.select(F.col("conv_id").isNull().cast("bigint").alias("no_conv"), F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv")).distinct(),
        ["no_conv", "conv"],
        "left_anti",
    )
    found = streams.mapInArrow(_applier(digest=True), f"no_conv long, conv long, {_REPORT}, repaired_sha256 string")
    empty = lost.select(
        "no_conv", "conv",
        *[F.lit(0).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"),
    )
    return found.unionByName(empty).select(
        F.when(F.col("no_conv") == 0, F.col("conv")).alias("conv_id"), *found.columns[2:]
    )


_SQL_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

# The same least ways, row by row: the least cost and audit of every last role.
SQL = rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_SQL_CRC} % 20 AS code FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE code WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM src
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM hurt
), marked AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS prior,
    CASE WHEN bare = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM placed
), edits(q, initial, q2, cost, edit) AS (
  VALUES (0, 's', 1, 0, 'K'), (0, 'u', 2, 0, 'K'), (1, 'u', 2, 0, 'K'), (2, 'a', 3, 0, 'K'), (3, 'u', 2, 0, 'K'),
    (0, NULL, 2, 2, 'R'), (1, NULL, 2, 2, 'R'), (2, NULL, 3, 2, 'R'), (3, NULL, 2, 2, 'R'),
    (0, NULL, 0, 3, 'D'), (1, NULL, 1, 3, 'D'), (2, NULL, 2, 3, 'D'), (3, NULL, 3, 3, 'D')
), inserts(q, q2, cost, edits) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''),
    (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 2, 2, 'I'), (1, 3, 4, 'II'), (2, 3, 2, 'I'), (3, 2, 2, 'I')
), ways AS (
  SELECT c.conv_id, 0::BIGINT AS pos, s.q2 AS q, {{'cost': s.cost, 'audit': s.edits}} AS way
  FROM (SELECT DISTINCT conv_id FROM conversations) c, inserts s WHERE s.q = 0
  UNION ALL
  SELECT w.conv_id, m.pos, s.q2,
    min({{'cost': w.way.cost + e.cost + s.cost + (CASE WHEN m.fault = 3 AND e.edit <> 'D' THEN 1 ELSE 0 END), 'audit': w.way.audit || e.edit || s.edits}})
  FROM ways w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.pos = w.pos + 1
  JOIN edits e ON e.q = w.q AND (e.initial IS NULL OR e.initial = m.initial) AND (e.edit = 'D' OR m.fault NOT IN (1, 2))
  JOIN inserts s ON s.q = e.q2
  GROUP BY w.conv_id, m.pos, s.q2
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated,
    count(*) FILTER (WHERE prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), best AS (
  SELECT w.conv_id, min(w.way) AS way FROM ways w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE w.q IN (0, 3) AND w.pos = coalesce(c.n, 0) GROUP BY w.conv_id
), letters AS (
  SELECT conv_id, generate_subscripts(string_split(way.audit, ''), 1) AS k, unnest(string_split(way.audit, '')) AS edit FROM best WHERE way.audit <> ''
), applied AS (
  SELECT conv_id, k, edit, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS pos,
    count(*) FILTER (WHERE edit <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS place
  FROM letters
), shown AS (
  SELECT a.*, m.role, m.text, max(CASE WHEN a.place = 1 AND a.edit = 'K' AND m.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY a.conv_id) AS system
  FROM applied a LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM a.conv_id AND m.pos = a.pos AND a.edit <> 'I'
), digests AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY place)) AS digest
  FROM shown WHERE edit <> 'D' GROUP BY conv_id
)
SELECT b.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, b.way.cost::BIGINT AS cost, b.way.audit AS audit,
  coalesce(d.digest, sha256('')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM b.conv_id
"""
