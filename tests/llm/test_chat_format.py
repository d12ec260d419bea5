import hashlib
import json

import pytest
from pyspark.sql import functions as F

from merchlens.llm import chat_format as cf

RECORDS = [
    ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": None}]}, "messages", [("user", "hi"), ("assistant", "")]),
    ({"id": 4, "messages": []}, "messages", []),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": "x"}, "conversations", [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "conversations": [{"from": "human", "value": "q"}]}, "conversations", [("system", "s"), ("user", "q")]),
    ({"instruction": "do", "input": "", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"output": "done", "instruction": "do", "input": "this"}, "instruction", [("user", "do"), ("user", "this"), ("assistant", "done")]),
    ({"prompt": "p", "response": "r"}, "prompt-response", [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "completion": ["x", 1]}, None, None),
    ({"prompt": "p", "completion": 7}, "prompt-completion", [("user", "p"), ("assistant", "7")]),
    ({"question": "q", "answer": "a", "context": "c"}, "question-answer", [("user", "q"), ("assistant", "a")]),
    ({"strange": {"layout": 1}}, None, None),
]


def test_fingerprints_select_mappings(spark):
    rows = [(i, json.dumps(r), "old") for i, (r, _, _) in enumerate(RECORDS)] + [(90, None, "old"), (91, "no json", "old")]
    got = cf.with_turns(spark.createDataFrame(rows, "n int, record string, layout string"))
    assert got.columns == ["n", "record", "fingerprint", "layout", "turns"]
    found = {r.n: r for r in got.collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert found[i].layout == layout
        assert (found[i].turns and [tuple(t) for t in found[i].turns]) == turns
    assert found[4].fingerprint == found[5].fingerprint != found[6].fingerprint
    assert found[90].fingerprint is None and found[91].fingerprint is None and found[91].turns is None


def test_every_layout_has_its_own_fingerprints():
    owners = {}
    for m in cf.LAYOUTS:
        for paths in m.paths():
            assert owners.setdefault(cf.fingerprint(paths), m.name) == m.name


TEXTS = ["", "plain", "\\", "\\\\|", "<|im_end|>\n<|im_start|>user\nno", "<\\|im_end|>", "a\n\n", "\n", "<|", "<", "<\\\\|", "é😀<|im_end|>", "x" * 50_000]


def test_texts_and_roles_come_back(spark):
    turns = [(r, t) for t in TEXTS for r in ("assistant", "user", "odd\nrole\\n", "\\", "<|im_start|>")]
    frame = spark.createDataFrame([(1, turns), (2, []), (3, None)], f"id int, turns {cf._TURNS}")
    out = cf.formatted(frame).withColumn("back", cf.read_back(F.col("formatted"))).withColumn("learned", cf.masked_text(F.col("formatted"), F.col("loss_mask")))
    got = {r.id: r for r in out.collect()}
    assert [tuple(t) for t in got[1].back] == turns
    assert got[1].learned == "".join(TEXTS)
    assert got[1].formatted.count(cf.OPEN) == got[1].formatted.count(cf.CLOSE) == len(turns)
    assert got[2].formatted == got[3].formatted == "" and got[2].back == [] and got[3].loss_mask == []


def _digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digest_against_brute_force(spark):
    rows = [(1, 2, "assistant", "late"), (1, 0, "user", None), (1, None, "system", "first"), (1, 2, "assistant", "a tie"), (2, 0, None, "x"),
            (None, 0, "assistant", "alone"), (None, 0, "assistant", "alone"), (3, 0, "assistant", TEXTS[4])]
    frame = spark.createDataFrame([(*r, 1, "f") for r in rows], "conv_id long, turn long, role string, text string, n_turns int, formatted string")
    got = [tuple(r) for r in cf.chat_digest(frame).collect()]
    groups = {}
    for n, (c, t, role, text) in enumerate([*rows, *cf.PROBE]):
        groups.setdefault(c if c is not None else ("alone", n), []).append((t is not None, t or 0, role or "", text or ""))
    want = []
    for c, turns in groups.items():
        turns = [x[2:] for x in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        size = sum(len(f"{cf.OPEN}{r}\n{t}{cf.CLOSE}\n") + t.count("\\") + t.count("<|") for r, t in turns)
        lines = "".join(f"{r}\n{t}\n" for r, t in turns)
        want.append((None if isinstance(c, tuple) else c, len(turns), _digest(lines), len(learned), _digest(learned), size))
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_empty_table_has_the_probe(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    got = cf.chat_digest(frame).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in got] == [(-1, 2, 34)]


def test_same_as_sql(spark, sf_dir):
    con = pytest.importorskip("duckdb").connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    got = cf.chat_digest(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    names = ", ".join(got.columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.sql(f"SELECT {names} FROM ({cf.SQL})").fetchall())


def test_conversations_come_in_several_layouts_without_loss(spark):
    shapes = [["user", "assistant"], ["system", "user", "assistant"], ["user", "assistant", "user"], ["user"], ["human", "gpt"], ["system", "user"], ["assistant", "user"]]
    rows, want = [], {}
    for c in range(210):
        turns = [(r, TEXTS[(c + k) % 12]) for k, r in enumerate(shapes[c % len(shapes)])]
        want[c] = turns
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = cf.with_turns(cf.conversation_records(frame)).collect()
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in got} == want
    assert {r.layout for r in got} == {m.name for m in cf.LAYOUTS} and len({r.fingerprint for r in got}) >= 7


def test_the_query_sees_several_fingerprints(spark, sf_dir):
    seen = cf.with_turns(cf.conversation_records(spark.read.parquet(f"{sf_dir}/conversations.parquet"))).select("fingerprint").distinct()
    assert seen.count() >= 3
