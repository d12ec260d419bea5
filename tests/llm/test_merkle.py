import random

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from merchlens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Root string, tree long"


def _rows(n=90):
    rng = random.Random(5)
    out = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "de", "fr", None, "é"])
        text = rng.choice([None, "", "plain", "ünïcödé ☃", "x" * 50_000, f"text {i}"])
        out.append((i, text, lang, rng.choice(["a", None]), rng.choice([None, len(text or ""), 7]), "mine", i))
    # Repeated rows, one id with two texts, a null id, a lone language.
    return [*out, out[3], (5, "other", "en", None, 1, None, 0), (None, "no id", "en", "a", 5, None, 0), (777, "alone", "zz", "a", 5, None, 0)]


def _expected(rows):
    return sorted(brute.merkle([(r[0], r[3], r[2], r[4], r[1]) for r in rows]), key=repr)


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_equals_brute_force(spark, bits):
    rows = _rows()
    found = merkle.manifest_report(spark.createDataFrame(rows, SCHEMA).repartition(7), bits=bits)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=repr) == _expected(rows)


@pytest.mark.parametrize("rows", [[], _rows()[:1], _rows()[:2], [(None, None, None, None, None, None, None)] * 5])
def test_small_tables(spark, rows):
    found = merkle.manifest_report(spark.createDataFrame(rows, SCHEMA), bits=2)
    assert sorted(map(tuple, found.collect()), key=repr) == _expected(rows)


def test_proofs_are_whole_and_other_columns_pass(spark):
    docs = spark.createDataFrame(_rows(), SCHEMA).withColumn("leaf", merkle.digest_of(F.col("doc_id"), F.col("text")))
    found = merkle.manifest(docs, "doc_id", "lang", bits=3)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "tree", "leaf", "subroot", "root", "proof"]
    assert found.filter(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert found.filter(merkle.folded(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).count() == 0


def test_queue_holds_two_digests_a_level(monkeypatch):
    held = []

    def push(queue, item, real=merkle.heapq.heappush):
        real(queue, item)
        held.append(len(queue))

    monkeypatch.setattr(merkle.heapq, "heappush", push)
    merkle.rise([f"{i:x}" for i in range(1000)], 10)
    assert max(held) <= 2 * 10


def test_sql(spark):
    rows = _rows()[:90]
    docs = duckdb.connect()
    docs.register("documents", spark.createDataFrame(rows, SCHEMA).toArrow())
    found = merkle.manifest_report(spark.createDataFrame(rows, SCHEMA))
    names = sorted(found.columns)
    want = docs.sql(merkle.SQL).project(", ".join(names)).fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in found.select(names).collect())
