import random

import brute
import duckdb
import pytest

from merchlens.llm import turn_repair
from merchlens.llm.turn_repair import NONE, repair_digest, repaired_turns, repairs, search, ways_through

SCHEMA = "conv_id long, turn long, role string, text string, block long, Cost string"


def _signature(kinds):
    return "".join("x" if gone else (c.upper() if cut else c) for c, gone, cut in ((k[0] if k[0] in "sua" else "o", *k[1:]) for k in kinds))


def _kinds(rng, n):
    return [(rng.choice("suuaao"), rng.random() < 0.15, rng.random() < 0.25) for _ in range(n)]


def _least(rows):
    return turn_repair._cheapest(ways_through(search, rows, NONE))


def test_search_against_every_script():
    rng = random.Random(1)
    for n in (0, 1, 2, 2, 3, 3, 3):
        kinds = _kinds(rng, n)
        assert _least(_signature(kinds)) == min(brute.scripts(kinds, 2 if n < 3 else 1)), kinds


@pytest.mark.parametrize("stretch", [1, 3, 48])
def test_search_against_least_ways(monkeypatch, stretch):
    monkeypatch.setattr(turn_repair, "STRETCH", stretch)
    rng = random.Random(stretch)
    for _ in range(300):
        kinds = _kinds(rng, rng.randrange(0, 30))
        assert _least(_signature(kinds)) == brute.least_edits(kinds), kinds


@pytest.mark.parametrize("rows", ["u" * 48, "s" * 48, "o" * 48, "U" * 48, "uuaa" * 12, "suX" * 16, "usa" * 16, "oO" * 24])
def test_a_stretch_is_searched_in_bounded_time(rows):
    import time

    rows = rows.replace("X", "x")
    began = time.monotonic()
    kinds = [(c.lower(), c == "x", c.isupper()) for c in rows]
    assert _least(rows) == brute.least_edits(kinds)
    assert time.monotonic() - began < 2


def _rows():
    rng = random.Random(7)
    texts = ["Yes.", "No!", "What?", "cut off", "", " \t", None, "Yes. ", "x" * 60_000 + "."]
    out = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 9)):
            out.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), rng.choice(["system", "user", "user", "assistant", "tool", "", None]), rng.choice(texts), 1, "mine"))
    # One long conversation, repeated rows, a conversation of which nothing is left.
    out += [(99, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "cut", f"{t}."]), 1, "mine") for t in range(400)]
    out += out[:3]
    gone = next(t for t in range(1000) if brute.crc(f"500:{t}") % 20 == 0)
    return [*out, (500, gone, "user", "Gone.", 1, "mine")]


def _expected(rows):
    # Rows of one turn (and, after damage, one role) lie by text here and by its digest there, so such rows are left out.
    return {c: brute.conversation_report(brute.damage([r[:4] for r in rows if r[0] == c])) for c in {r[0] for r in rows}}


def _without_ties(rows):
    seen = {}
    return [r for r in rows if seen.setdefault(r[:2], r) == r]


@pytest.mark.parametrize("bits", [3, 10])
def test_equals_brute_force(spark, bits):
    rows = _without_ties(_rows())
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = repair_digest(frame, block_bits=bits)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = _expected(rows)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(((c, *r) for c, (r, _) in want.items()), key=repr)
    told = repaired_turns(turn_repair.damaged(frame), block_bits=bits).collect()
    lines = sorted(((r.conv_id, r.place, r.role, r.text) for r in told), key=repr)
    assert lines == sorted(((c, k, *t) for c, (_, out) in want.items() for k, t in enumerate(out)), key=repr)


def test_ties_and_empty_table(spark):
    rows = [(1, 0, "user", t, 1, "") for t in ("A.", "B.", "C.", "A.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    (row,) = repairs(frame).collect()
    assert (row.conv_id, row.gaps, row.duplicate, row.illegal, row.cost) == (1, 0, 1, 3, 7)
    assert repair_digest(frame.limit(0)).collect() == [] and repaired_turns(frame.limit(0)).collect() == []


def test_sql(spark):
    rows = [r for r in _without_ties(_rows()) if r[0] != 99]
    con = duckdb.connect()
    con.register("conversations", spark.createDataFrame(rows, SCHEMA).toArrow())
    found = repair_digest(spark.createDataFrame(rows, SCHEMA))
    names = sorted(found.columns)
    want = con.sql(turn_repair.SQL).project(", ".join(names)).fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in found.select(names).collect())
