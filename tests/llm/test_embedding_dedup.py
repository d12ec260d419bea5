import brute
import numpy as np

from merchlens.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def _brute(rows):
    def sound(v, label):
        return label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if sound(v, lab) else None for _, v, lab in rows]

    def linked(i, j):
        a, b = unit[i], unit[j]
        return a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= 0.98

    label = brute.components(len(rows), linked)
    least = {}
    for (i, *_), at in zip(rows, label, strict=True):
        least[at] = min(least.get(at, i), i)
    return sorted(
        (i, sum(linked(k, j) for j in range(len(rows)) if j != k), least[at], least[at] == i)
        for k, ((i, *_), at) in enumerate(zip(rows, label, strict=True))
    )


def _rows(dim=24, groups=8, members=25):
    rng, rows = np.random.default_rng(1), []
    for g in range(groups):
        centre = rng.normal(size=dim)
        for _ in range(members):
            v = centre / np.linalg.norm(centre) + rng.normal(size=dim) * 0.1 / np.sqrt(dim) * rng.choice([0.3, 1.0, 1.5])
            rows.append((v * rng.choice([0.5, 4.0])).astype(np.float32).tolist())
    rows += [rng.normal(size=dim).astype(np.float32).tolist() for _ in range(150)] + [rows[0]] * 5 + [rows[30]] * 3
    labelled = [(int(i), v, int(i) % 2) for i, v in enumerate(rows)]
    return [*labelled, (900, None, 1), (901, [0.0] * dim, 1), (902, [float("nan")] + [1.0] * (dim - 1), 1), (903, rows[0], None),
            (904, [None] + [1.0] * (dim - 1), 1), (905, [float("inf")] + [1.0] * (dim - 1), 1), (906, [], 0), (907, [1.0, 2.0], 0), (908, [2.0, 4.0], 0)]


def _run(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in ed.embedding_groups(frame).collect())


def test_against_brute_force(spark, monkeypatch):
    rows = _rows()
    want = _brute(rows)
    assert _run(spark, rows) == want
    monkeypatch.setattr(ed, "_BLOCK", 7)
    monkeypatch.setattr(ed, "_ROWS_A_CALL", 100)
    assert _run(spark, rows) == want
    assert sum(n for _, n, _, _ in want) > 1000


def test_near_vectors_meet_in_a_bucket():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    away = rng.normal(size=a.shape)
    away -= (away * a).sum(axis=1, keepdims=True) * a
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * away
    left, right = (ed.polytope_codes(x, 2, ed.TABLES, ed.PROBES) for x in (a, b))
    met = (left[:, :, :, None] == right[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() > 0.999


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(ed._hadamard(ed._hadamard(x)), x) and np.allclose((ed._hadamard(x) ** 2).sum(1), (x**2).sum(1))


def test_odd_ids_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.01], 0), (None, None, 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = [tuple(r) for r in ed.embedding_groups(frame).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, False)]))
    assert ed.embedding_groups(frame.limit(0)).collect() == []
