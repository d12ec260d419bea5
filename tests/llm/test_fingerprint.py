import hashlib

import brute
from pyspark.sql import functions as F

from merchlens.llm import fingerprint as fp


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, sketch string, rank string")


def _text(a, n):
    return " ".join(f"w{(a * 7919 + i * 31) % 5003}" for i in range(n))


ROWS = [
    (5, _text(1, 400)), (2, _text(2, 3)), (9, None), (7, ""), (11, "é" * 11), (4, _text(1, 400)), (20, "x " * 60_000),
    (None, "no id here but five words"), (21, "   \t "),
]


def test_edited_texts_and_likeness(spark):
    rows = [(*r, "s", "r") for r in ROWS]
    got = {r.doc_id: r for r in fp.compare_with_edited(_docs(spark, rows)).collect()}
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(ROWS)
    for at, (i, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == brute.sha(edited)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[4].fingerprint == got[5].fingerprint and got[4].near_next == 1.0
    assert abs(got[5].near_edited - 1 / 3) < 0.15 and abs(got[5].held_by_edited - 0.5) < 0.15
    assert got[9].fingerprint == "" == got[7].fingerprint


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a b c d e f", "", ""), (1, "a b c d e f", "", ""), (1, "other words", "", ""), (2, "the end", "", "")]
    got = fp.compare_with_edited(_docs(spark, rows)).collect()
    assert len(got) == 4
    same = [tuple(r) for r in got if r.doc_id == 1 and r.n_chars == 11]
    assert len(same) == 3 and len(set(same)) == 2
    # A single document follows itself.
    alone = fp.compare_with_edited(_docs(spark, rows[3:])).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"the the").hexdigest()
    assert fp.compare_with_edited(_docs(spark, [])).collect() == []


def test_sketch_is_the_hashes_below_the_threshold(spark):
    docs = _docs(spark, [(1, _text(3, 500), "", ""), (2, "", "", ""), (3, "two words", "", "")])
    hashed = docs.select("doc_id", fp.word_hashes(F.col("text")).alias("h"))
    got = {r.doc_id: r for r in hashed.select("doc_id", fp.sketch(F.col("h"), fraction=0.25).alias("q"), fp.sketch(F.col("h"), fraction=1.0).alias("all")).collect()}
    assert got[1].q == [h for h in got[1]["all"] if h < -(1 << 63) + (1 << 62)]
    assert 60 < len(got[1].q) < 190 and got[2].q == [] and len(got[3].q) == 1


def test_merge_equals_the_sketch_of_both(spark):
    a, b = _text(4, 300), _text(9, 200)
    docs = spark.createDataFrame([(a, b)], "a string, b string")
    h = docs.select(fp.word_hashes(F.col("a")).alias("a"), fp.word_hashes(F.col("b")).alias("b"))
    row = h.select(fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    merged = row.select("a", "b", fp.merge(F.col("a"), F.col("b")).alias("m"), fp.containment(F.col("a"), fp.merge(F.col("a"), F.col("b"))).alias("c")).first()
    assert merged.m == sorted(set(merged.a) | set(merged.b)) and merged.c == 1.0


def test_added_column_replaces_one_of_its_name(spark):
    got = fp.with_fingerprint(_docs(spark, [(1, "a b c d e f g", "old", "r"), (2, None, "old", "r")]))
    assert got.columns == ["doc_id", "text", "rank", "sketch"]
    assert [len(r.sketch) > 0 for r in got.orderBy("doc_id").collect()] == [True, False]


def test_runs_without_python(spark, sf_dir):
    plan = fp.compare_with_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_texts_inside_long_ones_are_marked(spark):
    long = _text(3, 400)
    words = long.split(" ")
    # Short texts that the long one holds whole, each followed by it.
    rows = [(2 * i + k, t, "", "") for i in range(40) for k, t in enumerate((" ".join(words[i : i + 5]), long))]
    got = {r.doc_id: r for r in fp.compare_with_edited(_docs(spark, rows)).collect()}
    short = [got[2 * i] for i in range(40)]
    assert {(r.held_by_next == 1.0) for r in short} == {True, False}
    # Where the sketch holds the short text's hash it tells; everywhere else it says that it cannot.
    assert all(r.next_too_short == (r.held_by_next < 1.0) for r in short)
    assert not got[1].edited_too_short
    # Equal texts and empty ones are told.
    equal = fp.compare_with_edited(_docs(spark, [(1, "two words", "", ""), (2, "two words", "", ""), (3, "", "", "")])).collect()
    assert [r.next_too_short for r in sorted(equal, key=lambda r: r.doc_id)] == [False, False, False]
