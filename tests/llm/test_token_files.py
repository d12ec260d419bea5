import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from merchlens.llm import repair
from merchlens.llm.queries import vocabulary
from merchlens.llm.token_files import byte_bpe_units, read_token_files, write_token_files
from merchlens.llm.units import Units
from merchlens.session import scratch_path

tokenizers = pytest.importorskip("tokenizers")
TEXTS = ["", None, "  a b  c\n\n d", "a  b", " <|endoftext|> x<|endoftext|>y", "\xa0a \xa0 b　 c", "it's \n y", "tab\t b", "  ", "one two two two " * 900, "é😀" * 40]


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=40), max_size=8), st.integers(1, 6))
def test_grammar_round_trip(docs, rounds):
    docs = [d * 5 for d in docs]
    ids, lengths = np.array([i for d in docs for i in d], np.int64), np.array([len(d) for d in docs], np.int64)
    shard = repair.Shard(repair.pack(ids, lengths, 5, rounds=rounds, min_share=0.01))
    assert shard.expand(shard.symbols).tolist() == ids.tolist()
    assert [shard.document(i).tolist() for i in range(len(docs))] == docs
    for a, b in ((0, 3), (2, 17), (len(ids) - 4, len(ids) + 9), (5, 5)):
        assert shard.slice(a, b).tolist() == ids[max(a, 0) : b].tolist()
    assert shard.spans[5:].tolist() == repair.expansion_lengths(shard.rules, 5).tolist()


def test_repeated_ids_are_replaced_by_rules():
    ids = np.tile(np.array([7, 8, 9, 7, 8, 3]), 500)
    rules, symbols, counts = repair.compress(ids, np.array([len(ids)]), 50)
    assert len(symbols) < len(ids) / 5 and len(rules) >= 3 and counts.tolist() == [len(symbols)]
    assert len(repair.pack(ids, np.array([len(ids)]), 50)) < len(ids)


def _write(spark, rows, **how):
    path = scratch_path(spark, "tokens")
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, start string").repartition(3)
    write_token_files(docs, path, vocabulary("byte_bpe_50k.json"), **how)
    return path


def test_files_hold_all_ids_in_order(spark, tokenizer):
    rows = [(100 - 7 * i, t) for i, t in enumerate(TEXTS)] + [(None, "no id")]
    path = _write(spark, rows, shard_ids=50)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for i, text in order:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), ids))
        start += len(ids)
    got = [tuple(r) for r in read_token_files(spark, path).orderBy("start").collect()]
    assert got == want
    sums = read_token_files(spark, path, summary=True).orderBy("start").collect()
    assert [r.ids_crc32 for r in sums] == [zlib.crc32(np.array(w[3], "<u4").tobytes()) for w in want]


def test_shared_ids_repeated_rows_and_empty_table(spark, tokenizer):
    path = _write(spark, [(1, "a b"), (1, "a b"), (1, "c"), (0, "z")])
    got = read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [0, 1, 1, 1] and len({r.start for r in got}) == 4
    assert sorted(tokenizer.decode(r.ids[:-1]) for r in got) == ["a b", "a b", "c", "z"]
    assert read_token_files(spark, _write(spark, [])).collect() == []


def test_units_get_the_ids_that_each_gets_alone(tokenizer):
    units = [" a", "b", " <|endoftext|>x", " c ", " it's", " \n", "\n d", " é😀", " \x1c", " 12,", "", " e" * 120, " z"]
    for own in (units, [u for u in units if "<|" not in u] * 60):
        joining = np.array([u[:1] == " " and u[1:].strip() == u[1:] != "" for u in own])
        ids, counts = byte_bpe_units(vocabulary("byte_bpe_50k.json")).encode(own, joining)
        want = [tokenizer.encode(u, add_special_tokens=False).ids for u in own]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_marks_behind_letters_are_units_of_their_own(tokenizer):
    texts = ["a x, y... z?! é, ü. ж, 日, 1, x), it's, don't. \n, q\n, <|endoftext|>, x", "to. no, .", "so, so. so", "a b,\u00a0c, d ,. e,"]
    table = byte_bpe_units(vocabulary("byte_bpe_50k.json"))
    ids, counts = table.ids(texts)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert "so" in table.numbers and "so," not in table.numbers and "so." not in table.numbers


def test_only_distinct_units_are_looked_up(tokenizer, monkeypatch):
    asked = []
    numbered = Units._numbered
    monkeypatch.setattr(Units, "_numbered", lambda self, parts: asked.append(len(parts)) or numbered(self, parts))
    texts = ["one two " * 500 + "three", "", "two one\tone", " two", "two  one", "two"]
    ids, counts = byte_bpe_units(vocabulary("byte_bpe_50k.json")).ids(texts)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert sum(asked) < 30
