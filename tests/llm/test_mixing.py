import random

import brute
import pytest
from pyspark.sql import functions as F

from merchlens.llm import mixing

LEVELS = ["domain", "lang", "source"]
WEIGHTS = {"domain": {"web": 0.6, "books": 0.3, "code": 0.1}, "lang": {"en": 3.0, "de": 1.0}, "source": {"s1": 2.0}}


def _rows(n=400):
    rng, out = random.Random(8), []
    for i in range(n):
        domain = rng.choices(["web", "books", "code", None], [70, 15, 10, 5])[0]
        lang = rng.choices(["en", "de", "fr", None], [60, 20, 15, 5])[0]
        text = rng.choice([None, "", "word " * rng.randrange(1, 60), "x y z"])
        out.append((i * 3, text, domain, lang, rng.choice(["s1", "s2", "s3"])))
    return out


def _run(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "old", "row") for r in rows], "doc_id long, text string, domain string, lang string, source string, epoch string, tokens string")
    got = mixing.mix(docs, LEVELS, WEIGHTS, **how)
    assert got.columns == ["doc_id", "text", *LEVELS, "tokens", "epoch"]
    return got


@pytest.mark.parametrize("share, epochs", [(0.3, 1), (0.9, 1), (1.0, 2), (2.5, 4), (9.0, 3)])
def test_against_brute_force(spark, share, epochs):
    rows = _rows()
    got = sorted((r.doc_id, r.epoch) for r in _run(spark, rows, share=share, max_epochs=epochs, seed=4).select("doc_id", "epoch").collect())
    assert got == brute.mixed(rows, [WEIGHTS[k] for k in LEVELS], share, epochs, seed=4)


def test_tokens_follow_weights_where_supply_allows(spark):
    rows = [(i, "a b c d e", ["web", "books"][i % 2], "en", f"s{i % 3}") for i in range(3000)]
    got = _run(spark, rows, share=0.2, max_epochs=1).groupBy("domain").agg(F.sum("tokens").alias("t")).collect()
    total = 0.2 * 15_000
    assert {r.domain: round(r.t / total, 2) for r in got} == {"web": 0.67, "books": 0.33}


def test_other_seeds_choose_others_and_rows_go_together(spark):
    rows = _rows() + [(6, "a b", "web", "en", "s1")] * 3
    sets = [set(_run(spark, rows, share=0.4, max_epochs=1, seed=s).select("doc_id").toPandas().doc_id) for s in (0, 1)]
    assert sets[0] != sets[1]
    counts = _run(spark, rows, share=0.4, max_epochs=1).groupBy("doc_id").count().filter("count > 1").collect()
    assert all(r["count"] == 4 for r in counts)


def test_odd_tables(spark):
    assert _run(spark, []).collect() == []
    assert [r.doc_id for r in _run(spark, [(1, None, None, None, None), (None, "", None, None, None)]).orderBy("doc_id").collect()] == [None, 1]
    assert _run(spark, [(1, "a", "web", "en", "s1")], share=1.0, max_epochs=1).count() == 1


def test_names_that_differ_in_case_only(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5, 6)], "doc_id long, text string, lang string, Tokens int, EPOCH int")
    got = mixing.mix(docs, levels=("lang",), weights={}, share=1.0, max_epochs=1)
    assert got.columns == ["doc_id", "text", "lang", "tokens", "epoch"] and [r.tokens for r in got.collect()] == [2]


def test_counted_rows_are_written_to_few_files(spark, monkeypatch):
    staged = {}
    real = mixing.stage

    def watched(df, label):
        staged[label] = out = real(df, label)
        return out

    monkeypatch.setattr(mixing, "stage", watched)
    docs = spark.createDataFrame(_rows(), "doc_id long, text string, domain string, lang string, source string").repartition(40)
    mixing.mix(docs, LEVELS, WEIGHTS, share=0.5, max_epochs=1)
    assert len(staged["mix-rows"].inputFiles()) <= 4
    assert staged["mix-rows"].count() == 400
