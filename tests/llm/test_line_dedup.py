import random

import brute
import pytest

from merchlens.llm.line_dedup import SQL, drop_repeated_lines, line_dedup_digest

LONG = "this line is long enough to count"


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_lines string, row string")


def _rows():
    rng = random.Random(3)
    lines = [f"a passage number {i} that some texts share" for i in range(6)] + ["short", "", "  ", LONG.upper() + " \t"]
    out = []
    for i in range(60):
        text = "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 9)))
        out.append((i * 7 % 61, text))
    out += [(100, None), (101, ""), (102, "\n"), (103, LONG), (104, f"{LONG}\n{LONG}\n" + "x" * 200_000), (None, LONG), (None, f" {LONG}")]
    return out


def test_against_brute_force(spark):
    rows = _rows()
    got = drop_repeated_lines(_frame(spark, [(*r, "old", "kept") for r in rows]))
    assert got.columns == ["doc_id", "text", "row", "n_lines", "n_dropped"]
    want = sorted(str((i, *w)) for (i, _), w in zip(rows, brute.kept_lines(rows), strict=True))
    assert sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.text)) for r in got.collect()) == want
    assert any(r.n_dropped for r in got.collect())


def test_rows_that_share_an_id_are_one_document(spark):
    rows = [(1, LONG), (1, LONG), (1, f"{LONG}\nmore"), (2, LONG)]
    got = sorted((r.doc_id, r.text) for r in drop_repeated_lines(_frame(spark, [(*r, "", "") for r in rows])).collect())
    assert got == [(1, LONG), (1, LONG), (1, f"{LONG}\nmore"), (2, LONG)]
    rows.append((3, LONG))
    got = sorted((r.doc_id, r.text) for r in drop_repeated_lines(_frame(spark, [(*r, "", "") for r in rows])).collect())
    assert got == [(1, ""), (1, ""), (1, "more"), (2, ""), (3, LONG)]


def test_empty_table(spark):
    assert line_dedup_digest(_frame(spark, [])).collect() == []


def test_runs_without_python(spark, sf_dir):
    plan = line_dedup_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_same_as_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = line_dedup_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    want = sorted(con.sql(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({SQL})").fetchall())
    assert sorted(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()) == want


def test_names_that_differ_in_case_only(spark):
    docs = spark.createDataFrame([(1, "a line\nb", 5, "r"), (2, "b", 6, "r")], "doc_id long, text string, N_Lines int, ROW string")
    got = drop_repeated_lines(docs)
    assert got.columns == ["doc_id", "text", "ROW", "n_lines", "n_dropped"] and got.count() == 2
