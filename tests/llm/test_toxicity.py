import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlens.llm import toxicity as tx

INSULTS = ["idiot", "moron", "worthless", "pathetic"]


def _kernel(a, b):
    """The subsequence kernel by enumeration; each occurrence counts in the length to which it is scaled."""

    def parts(word):
        codes = [c for c in map(tx._letter, word) if c]
        for size in (3, 4):
            for at in itertools.combinations(range(len(codes)), size):
                if at[-1] - at[0] <= tx.REACH:
                    yield tuple(codes[i] for i in at), tx.DECAY ** (at[-1] - at[0] + 1)

    x, y = list(parts(a)), list(parts(b))
    norm = np.sqrt(sum(w * w for _, w in x) * sum(w * w for _, w in y))
    return sum(v * w for (c, v) in x for (d, w) in y if c == d) / norm if norm else 0.0


def test_kernel_against_enumeration():
    words = ["idiot", "i-d-i-o-t", "idiiot", "banana", "ab", "x.y", "Größe", "1d10t", "moronic"]
    got = tx._features(words, ["idiot", "moron", "banana"])
    want = [[_kernel(w, v) for v in ("idiot", "moron", "banana")] for w in words]
    assert np.allclose(got, want)
    assert got[1, 0] == got[7, 0] == got[0, 0] and got[2, 0] > 0.6 and got[4].tolist() == [0, 0, 0]


def _corpus():
    rng = random.Random(6)
    parts = ["th", "an", "er", "ou", "re", "st", "ing", "ed", "ly", "ha", "on", "ti"]

    def sentence():
        return " ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 14))) + "."

    rows = []
    for i in range(600):
        lines, toxic = [sentence() for _ in range(rng.randrange(1, 6))], i % 4 == 0
        if toxic:
            w = lines[0].split(" ")
            w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
            lines[0] = " ".join(w)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    rows = _corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows if i % 3] + [(None, 1), (5, 1), (5, 0)], "doc_id long, toxic int")
    return docs, {i: t for i, _, t in rows}, tx.train(docs, labels)


def test_held_out_documents(spark, trained):
    docs, truth, model = trained
    got = tx.with_toxicity(docs, model).filter("doc_id % 3 = 0").collect()
    assert np.mean([(r.score >= 0.5) == bool(truth[r.doc_id]) for r in got]) > 0.98


def test_gaps_and_inserted_characters(spark, trained):
    _, _, model = trained
    clean = "thaner oure sting han er the tion. " * 40
    bad = [clean + x + " " + clean for x in ("idiot", "IDIOT!", "i-d-i-o-t", "id.iot", "m o r o n", "m0ron", "wor-thless", "xxpatheticxx")]
    rows = [(i, t, "old") for i, t in enumerate(bad)] + [(50, clean, "old"), (51, "", "old"), (52, None, "old"), (53, "a b", "old"), (54, clean * 300, "old")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = tx.with_toxicity(docs, model)
    assert got.columns == ["doc_id", "text", "score"]
    score = {r.doc_id: r.score for r in got.collect()}
    assert [i for i in range(len(bad)) if score[i] < 0.5] == []
    assert all(0 <= score[i] < 0.5 for i in (50, 51, 52, 53, 54))


def test_a_word_scores_alike_wherever_it_stands(trained):
    _, _, model = trained
    a = tx._Scorer(model).top(["some idiot here", "x" * 3000 + " idiot"])
    b = tx._Scorer(model).top(["idiot", "zz zz zz", "idiot!! zz idiot zz"])
    assert a[0, 0] == pytest.approx(b[0, 0]) and a[1, 0] >= b[0, 0] - 1e-9 and b[1, 0] < b[0, 0]
    assert b[0, 1] == tx.NOTHING and b[2, 0] == b[2, 1] == pytest.approx(b[0, 0]) and b[2, 2] < b[2, 1]


def test_labels_of_the_held_out_fifth_are_not_used(spark):
    rows = [(i, t, y) for i, t, y in _corpus()]
    docs = spark.createDataFrame([(i, t, "l", "s") for i, t, _ in rows], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    flipped = labels.withColumn("toxic", F.when(tx.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(tuple(r) for r in tx.toxicity_scores(docs, x).collect()) for x in (labels, flipped))
    assert a == b and len(a) == len(rows) and {r[1] for r in a} == {True, False}


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "idiot"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = tx.toxicity_scores(docs, labels).collect()
    assert len(got) == 2 and all(r.predicted == 0 and 0 <= r.score < 0.5 for r in got)
    assert tx.toxicity_scores(docs.limit(0), labels).collect() == []


def _learn(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return tx.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))


def test_one_in_a_hundred_labels_wrong(spark):
    rows = _corpus()
    # One toxic document with each insult among those flipped, and two clean ones.
    wrong = {next(i for i, t, y in rows if y and w in t.split()) for w in INSULTS} | {1, 2}
    assert len(wrong) == 6
    model = _learn(spark, [(i, t, 1 - y if i in wrong else y) for i, t, y in rows])
    score = model.probability(tx._Scorer(model).top([t for _, t, _ in rows]))
    assert np.mean([(s >= 0.5) == bool(y) for s, (_, _, y) in zip(score, rows)]) > 0.98


def test_a_rare_insult_is_learned_from_balanced_labels(spark):
    rng, rows = random.Random(3), _corpus()
    plain = [t for _, t, y in rows if not y]
    rows = [(i, rng.choice(plain).replace(" ", f" {rng.choice(INSULTS) if i % 120 else 'grumbald'} ", 1), 1) for i in range(0, 1200, 2)]
    rows += [(i, rng.choice(plain) + f" more{i}", 0) for i in range(1, 1200, 2)]
    assert 8 <= sum("grumbald" in t for _, t, _ in rows) < 15
    model = _learn(spark, rows)
    top = tx._Scorer(model).top(["thaner oure grumbald sting", "thaner oure idiot sting", "thaner oure sting han er"])
    assert (model.probability(top) >= 0.5).tolist() == [True, True, False]


def test_held_out_documents_of_the_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    found = tx.toxicity_scores(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    right = ((found.predicted == 1) & (found.toxic == 1)).sum()
    # Some toxic documents hold none of the words that others hold, so no learner finds all.
    assert right >= 0.8 * found.toxic.sum() and right >= 0.8 * found.predicted.sum()
    # In no language do clean documents go by the hundred, nor do toxic ones stay.
    for _, part in found.groupby("lang"):
        assert part.predicted[part.toxic == 0].mean() < 0.1 and part.predicted[part.toxic == 1].mean() > 0.6


def test_names_that_differ_in_case_only(spark):
    docs = spark.createDataFrame([(1, "idiot", 5, "r")], "doc_id long, text string, Score int, Row string")
    empty = tx.Model(np.zeros(0, np.int64), np.zeros(0), -1.0)
    assert tx.with_toxicity(docs, empty).columns == ["doc_id", "text", "Row", "score"]
