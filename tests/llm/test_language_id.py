import math
import random
import tracemalloc

import brute
import numpy as np
import pytest

from merchlens.llm import language_id
from merchlens.llm.language_id import WINDOW, Network, language_report, padded, train, with_language

SCHEMA = "doc_id long, text string, lang string, Score string, row string"
SOUNDS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ei", "ß"], "cc": ["ça", "eau", "qui", "té"]}


def _text(rng, lang, words):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def _docs(n=240):
    rng = random.Random(2)
    rows = [(i, _text(rng, lang, rng.choice([1, 5, 40])), lang, "mine", "r") for i, lang in enumerate(rng.choices(list(SOUNDS), [6, 2, 1], k=n))]
    rows += [(1000, None, "aa", "", ""), (1001, "", "aa", "", ""), (1002, "12 34 !?", "bb", "", ""), (1003, "ka lo", None, "", "")]
    rows += [(1004, _text(rng, "bb", 60_000), "bb", "", ""), (None, _text(rng, "cc", 30), "cc", "", ""), rows[0], rows[0]]
    return rows


def _slow(net, text):
    """Means of the probabilities, unit by unit and byte by byte."""
    data = text.encode()
    total = np.zeros(len(net.languages))

    def sigmoid(v):
        return 1 / (1 + math.exp(-v))

    def states(d, window):
        size = len(d.new_offset)
        h, out = [0.0] * size, []
        for c in window:
            own = [[sum(h[j] * d.state_in[g][j][k] for j in range(size)) for k in range(size)] for g in range(3)]
            after = []
            for k in range(size):
                z, r = (sigmoid(d.bytes_in[g][c][k] + own[g][k]) for g in (0, 1))
                new = math.tanh(d.bytes_in[2][c][k] + r * (own[2][k] + d.new_offset[k]))
                after.append((1 - z) * new + z * h[k])
            h = after
            out.append(h)
        return out

    for a in range(0, len(data), WINDOW):
        window = data[a : a + WINDOW]
        for f, b in zip(states(net.forward, window), states(net.backward, window[::-1])[::-1], strict=True):
            e = np.exp(np.array(f + b) @ net.out + net.offset)
            total += e / e.sum()
    return total / max(len(data), 1)


def test_documents_equal_a_slow_network():
    net = Network.new(["a", "b", "c"], states=5, seed=3)
    rng = random.Random(1)
    texts = [_text(rng, rng.choice(list(SOUNDS)), n) for n in (1, 2, 9, 30, 60)] + ["", "x" * WINDOW, "é" * WINDOW]
    assert np.allclose(net.documents(texts), [_slow(net, t) for t in texts], atol=1e-5)
    # A group of windows may span texts, and a text groups.
    many = [texts[4]] * 900
    assert np.allclose(net.documents(many), net.documents(many[:1]), atol=1e-6)


@pytest.mark.parametrize("steep", [1, 400])
def test_documents_equal_a_slow_network_with_offsets(steep):
    net = Network.new(["a", "b", "c"], states=5, seed=4)
    rng, some = random.Random(5), np.random.default_rng(6)
    for d in (net.forward, net.backward):
        d.bytes_in *= steep  # gates far beyond where their exponentials are infinite
        d.new_offset += some.normal(0, 1, 5)
    net.offset += some.normal(0, 1, 3)
    texts = [_text(rng, rng.choice(list(SOUNDS)), n) for n in (1, 1, 2, 3, 5, 9, 40)] + ["", "k", "ß" * WINDOW]
    with np.errstate(all="raise", under="ignore"):
        found = net.documents(texts)
    assert np.allclose(found, [_slow(net, t) for t in texts], atol=1e-5)


def test_reading_uses_its_room_again(monkeypatch):
    net = Network.new(["a", "b", "c", "d"])
    texts = ["ka lo mi " * 3000] * 4

    def peak(some):
        tracemalloc.start()
        net.documents(some)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    # States of all bytes of a group of windows, in both directions, are 2.6 MB.
    assert peak(texts) < 2.6e6
    # Twice as slow as exponentials on CPUs without AVX-512.
    monkeypatch.setattr(np, "tanh", None)
    assert np.allclose(net.documents(texts).sum(axis=1), 1, atol=1e-5)


def test_gradients_equal_differences():
    net = Network.new(["a", "b"], states=3, seed=1, kind=np.float64)
    rng = np.random.default_rng(0)
    x, mask = padded([rng.integers(0, 256, n).astype(np.uint8) for n in (7, 3, 1)])
    mask, truth = mask.astype(np.float64), np.array([0, 1, 1])
    _, slopes = net.gradients(x, mask, truth)
    for w, g in zip(net.weights(), slopes, strict=True):
        spots = [np.unravel_index(i, w.shape) for i in rng.choice(w.size, min(w.size, 12), replace=False)]
        spots += [(k, x[0, 0], 0) for k in range(3)] if w.ndim == 3 and w.shape[1] == 256 else []
        for at in spots:
            before = w[at]
            w[at] = before + 1e-6
            up = net.gradients(x, mask, truth)[0]
            w[at] = before - 1e-6
            down = net.gradients(x, mask, truth)[0]
            w[at] = before
            assert abs((up - down) / 2e-6 - g[at]) < 1e-6


def test_report(spark):
    rows = _docs()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = language_report(frame)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    out = sorted(found.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    truth = {r[0]: r[2] for r in rows}
    assert [r.doc_id for r in out] == sorted([r[0] for r in rows], key=lambda i: (i is None, i or 0))
    for r in out:
        assert r.held_out == (r.doc_id is not None and brute.crc(str(r.doc_id)) % 3 == 1) and 0 <= r.score <= 1
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    wrong = [r.doc_id for r in out if r.held_out and r.doc_id < 1000 and r.lang_pred != truth[r.doc_id]]
    assert len(wrong) <= 3
    assert {r.lang_pred for r in out if r.doc_id in (1003, 1004, None)} == {"aa", "bb", "cc"}


def test_without_anything_to_learn(spark):
    rows = [(1, "ka lo", None, "", ""), (3, None, "aa", "", ""), (5, "12", "bb", "", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert train(frame) is None
    assert [(r.lang_pred, r.score) for r in language_report(frame).collect()] == [("und", 0.0)] * 3
    assert language_report(frame.limit(0)).collect() == []


def test_other_columns_pass(spark):
    frame = spark.createDataFrame(_docs(60), SCHEMA)
    net = Network.new(["aa"])
    out = with_language(frame, net)
    assert out.columns == ["doc_id", "text", "lang", "row", "lang_pred", "score"]
    assert {r.lang_pred for r in out.collect()} == {"aa", "und"}


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "PER_LANGUAGE", 10)
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    languages, windows, truth = language_id._sample(spark.createDataFrame(_docs(2000), SCHEMA), "doc_id", "text", "lang")
    assert languages == ["aa", "bb"]
    assert max(map(len, windows)) <= WINDOW and np.bincount(truth).max() <= 10 * language_id.PER_DOCUMENT


@pytest.mark.parametrize("size", ["0.01"])
def test_held_out_documents_of_the_given_tables(spark, size):
    docs = spark.read.parquet(f"/root/testdata/sf{size}/documents.parquet")
    found = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang_pred != 'und'")
    right, n = found.selectExpr("sum(int(lang_pred = lang))", "count(lang)").first()
    assert right >= 0.98 * n
