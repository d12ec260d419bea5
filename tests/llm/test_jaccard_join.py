import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from merchlens.llm import jaccard_join as jj
from merchlens.llm import worker
from merchlens.llm.part_enum import Bands, profile, signatures, with_possible_partner
from merchlens.llm.word_sets import shingle_sets


@pytest.mark.parametrize("num", [50, 80, 95])
def test_similar_sets_share_a_signature(num):
    rng, bands, similar = np.random.default_rng(num), Bands(num, 100), 0
    for _ in range(1500):
        n = int(rng.choice([1, 2, 3, 4, 5, 7, 9, 14, 20, 33, 60, 150, 400]))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        keep = a[rng.random(len(a)) > rng.random() * (1 - num / 100)]
        more = rng.integers(0, 1 << 63, int(rng.random() * len(a) * (1 - num / 100)), dtype=np.int64).astype(np.uint64) * np.uint64(2)
        b = np.unique(np.concatenate([keep, more]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < num * (len(a) + len(b) - both):
            continue
        similar += 1
        assert with_possible_partner([profile(a), profile(b)], np.array([len(a), len(b)]), np.array([0, 1]), bands).all(), (len(a), len(b), both)
        assert not with_possible_partner([profile(a), profile(b)], np.array([len(a), len(b)]), np.array([1, 1]), bands).any()
        if len(a) == len(b) == both:
            assert np.array_equal(signatures(a, bands), signatures(b, bands))
        else:
            assert len(np.intersect1d(signatures(a, bands), signatures(b, bands))), (len(a), len(b), both)
    assert similar > 300


def test_sets_without_enough_solid_parts_still_meet():
    # All elements in a few cells: most parts are empty, so empty signatures are given too.
    bands = Bands()
    a = np.arange(100, dtype=np.uint64) + np.uint64(1 << 40)
    b = a[:90]
    assert len(np.intersect1d(signatures(a, bands), signatures(b, bands)))


def test_shingles_of_odd_texts():
    texts = ["", None, "one", "One  TWO\x0bthree\tfour", "a b c d e", "A b\nc d e f", "é É x" + " y" * 9, "z" * 300 + " a b c d", "z" * 300 + " A b c d"]
    sets = list(shingle_sets(pa.array(texts), 5))
    assert [len(s) for s in sets] == [len(brute.shingles(t)) for t in texts]
    assert np.array_equal(sets[7], sets[8])
    assert not len(np.intersect1d(sets[2], sets[3]))


def _variants(rng, base, count):
    out = []
    for _ in range(count):
        w = base[:]
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(999)}"
        out.append(" ".join(w))
    return out


def _rows():
    rng, rows = random.Random(5), []
    passage = " ".join(f"p{i}" for i in range(55))
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(rng.choice([6, 12, 60, 120]))]
        rows += _variants(rng, base, 14)
    rows += [f"{passage} " + " ".join(f"d{d}x{i}" for i in range(rng.choice([30, 60, 90]))) for d in range(25)]
    rows += ["a b c", "a b c", "A b c", "a b", "", None, "  ", "one two three four five six"] * 3
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows, strict=True))


def _run(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, n int").repartition(4)
    return sorted(map(str, map(tuple, jj.jaccard_groups(docs, **how).collect())))


def test_against_brute_force(spark, monkeypatch):
    rows = _rows()
    want = sorted(map(str, brute.jaccard_components(rows)))
    assert _run(spark, rows) == want
    # The same with buckets cut into many blocks, and class texts joined by a shuffle.
    monkeypatch.setattr(jj, "_CALL_BYTES", 2_000)
    monkeypatch.setattr(jj, "_BROADCAST_KEYS", 0)
    assert _run(spark, rows) == want


def test_odd_ids_and_empty_table(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (1, "x y z u v w"), (1, "a b c d e f"), (None, "only here it is so")]
    got = _run(spark, rows)
    assert got == sorted(map(str, [(3, 2, 1), (3, 2, 1), (None, 2, 1), (1, 2, 1), (1, 2, 1), (None, 1, None)]))
    assert _run(spark, []) == []


def test_keeps_one_of_each_group(spark):
    rows = _rows()
    docs = spark.createDataFrame([(*r, "a") for r in rows], "doc_id long, text string, g_id string")
    kept = sorted(r.doc_id for r in jj.keep_one_of_each_group(docs).collect())
    assert kept == sorted(i for i, _, c in brute.jaccard_components(rows) if i == c)


@pytest.mark.parametrize("changed", [(3, 6), (6, 9)])
def test_links_of_a_call_are_no_more_than_its_classes(changed):
    rng = random.Random(changed[0])
    base = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(200):
        w = base[:]
        for _ in range(rng.randrange(*changed)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    sets = list(shingle_sets(pa.array(texts), 5))
    label = np.arange(len(sets))
    links = jj.joining_links(sets, label, 80, 100)
    assert len(links) < len(sets)
    want = [c for _, _, c in brute.jaccard_components(list(enumerate(texts)))]
    assert [min(np.flatnonzero(label == x)) for x in label] == want


def test_family_and_common_passage_make_few_rows(spark):
    rng = random.Random(8)
    base, passage = [f"b{i}" for i in range(300)], [f"p{i}" for i in range(150)]
    rows = []
    for i in range(300):
        w = base[:]
        for _ in range(rng.randrange(3, 6)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(passage + [f"o{i}x{k}" for k in range(150)])) for i in range(300)]
    sizes = []

    def counted(df, label, real=jj.stage):
        out = real(df, label)
        if label in ("found", "open"):
            sizes.append(out.count())
        return out

    jj.stage, real = counted, jj.stage
    try:
        got = _run(spark, rows)
    finally:
        jj.stage = real
    assert got == sorted(map(str, brute.jaccard_components(rows)))
    assert max(sizes) <= 20 * len(rows), sizes


def test_tables_that_another_operator_left_go():
    held = worker.kept("another operator", "table", lambda: list(range(1000)))
    assert worker.kept("another operator", "table", list) is held
    texts = pa.RecordBatch.from_arrays([pa.array(["a b c d e f"])], ["text"])
    list(jj._sign(5, 80, 100)(iter([texts])))
    assert worker.kept("another operator", "table", list) == []
