import math
from collections import Counter

import brute
import numpy as np
import pytest

from merchlens.llm import sentence_pieces as sp
from merchlens.llm.queries import vocabulary

pytest.importorskip("sentencepiece")
TEXTS = ["", " ", "  a b  c\n\n d", "a  b", "▁x ▁", "\xa0a \xa0 b　 c", "x \n y", "tab\t b", "   ", "<s> </s><0x41>\x00", "日本語 😀 text", "a" * 3000, "one two", "\n"]


@pytest.fixture(scope="module")
def pieces():
    return sp.Vocabulary(vocabulary("piece_bpe_32k.model"))


def _split(ids, counts):
    return [tuple(x.tolist()) for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_round_trip_and_independence_of_batches(pieces):
    whole = _split(*sp.Lattices(pieces, sp.THETA).sample(TEXTS, np.arange(len(TEXTS))))
    assert [pieces.decode(list(i)) for i in whole] == TEXTS
    small = sp.Lattices(pieces, sp.THETA, limit=1)
    alone = [_split(*small.sample([t], np.array([k])))[0] for k, t in enumerate(TEXTS)]
    assert alone == whole


def _paths(pieces, model, text, theta):
    known = {model.id_to_piece(i): (i, model.get_score(i)) for i in range(259, model.get_piece_size())}

    def cut(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in known:
                i, score = known[rest[:k]]
                for ids, w in cut(rest[k:]):
                    yield (i, *ids), w + theta * score

    return dict(cut(text))


@pytest.mark.parametrize("text, theta", [("there", 2e-4), ("to  be", 1e-3), ("on in", 5e-5)])
def test_samples_follow_the_weights_of_all_paths(pieces, text, theta):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    logs = _paths(pieces, model, "▁" + text.replace(" ", "▁"), theta)
    weights = {k: math.exp(w - max(logs.values())) for k, w in logs.items()}
    n, total = 30_000, sum(weights.values())
    found = Counter(_split(*sp.Lattices(pieces, theta).sample([text] * n, np.arange(n))))
    assert set(found) <= set(weights)
    for path, w in weights.items():
        p = w / total
        assert abs(found[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_encode_and_decode_frames(spark):
    rows = [(i, t, "old", "r") for i, t in enumerate(TEXTS)] + [(None, "no id", "old", "r"), (99, None, "old", "r"), (3, TEXTS[3], "old", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, row string").repartition(3)
    path = vocabulary("piece_bpe_32k.model")
    coded = sp.encode(docs, path)
    assert coded.columns == ["doc_id", "text", "row", "ids"]
    got = sp.decode(coded, path).collect()
    assert len(got) == len(rows) and all(r.decoded == (r.text or "") for r in got)
    twice = [r.ids for r in got if r.doc_id == 3]
    assert len(twice) == 2 and twice[0] == twice[1]
    other = {r.doc_id: r.ids for r in sp.encode(docs.repartition(1), path, seed=5).collect()}
    assert any(other[r.doc_id] != r.ids for r in got)
    done = {r.doc_id: r for r in sp.coded_documents(docs.coalesce(1), path).collect()}
    for r in got:
        assert done[r.doc_id].ids == r.ids and done[r.doc_id].n_tokens == len(r.ids)
        assert done[r.doc_id].decoded_sha256 == brute.sha(r.text or "")
    assert sp.coded_documents(docs.limit(0), path).collect() == []


def test_units_share_the_lattices_of_their_links(pieces):
    marks = [m for m in ".,;:!?" if sp._pair(ord("e"), ord(m)) not in pieces.pairs.to_pylist()]
    assert len(marks) > 1
    lattices = sp.Lattices(pieces, sp.THETA)
    text = " ".join(["there", *("there" + m for m in marks)])
    ids, counts = lattices.sample([text, "there"], np.arange(2))
    assert [pieces.decode(i) for i in _split(ids, counts)] == [text, "there"]
    # A link of n characters has n + 1 nodes.
    assert len(lattices.head) == len(" there") + 1 + 2 * len(marks)


def test_samples_of_linked_units_follow_the_weights_of_all_paths(pieces):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    logs = _paths(pieces, model, "▁to,in", 5e-4)
    assert len(pieces.pairs.filter(np.isin(pieces.pairs.to_numpy(), [sp._pair(ord("o"), ord(","))]))) == 0
    weights = {k: math.exp(w - max(logs.values())) for k, w in logs.items()}
    n, total = 20_000, sum(weights.values())
    found = Counter(_split(*sp.Lattices(pieces, 5e-4, limit=3).sample(["to,in"] * n, np.arange(n))))
    assert set(found) <= set(weights)
    for path, w in weights.items():
        p = w / total
        assert abs(found[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_forgotten_units_change_nothing(pieces):
    lattices, texts = sp.Lattices(pieces, sp.THETA, limit=2), [f"word{i}, and word{i % 3}" for i in range(9)]
    want = _split(*sp.Lattices(pieces, sp.THETA).sample(texts, np.arange(9)))
    got = [_split(*lattices.sample([t], np.array([k])))[0] for k, t in enumerate(texts)]
    assert got == want and len(lattices.links) >= 4
