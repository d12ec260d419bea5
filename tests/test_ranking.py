import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlens.operators import selection
from merchlens.operators.ranking import tile_of, with_group_rank, with_rank
from merchlens.operators.running import rows_between, running_by_value
from merchlens.operators.selection import grouped_quantiles


@pytest.fixture()
def many_partitions(spark):
    """Keep every range partition, so ranks must be carried across them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _values(n, distinct):
    rnd = random.Random(n)
    return [(i, rnd.randrange(distinct)) for i in range(n)]


def _ntile(n, k):
    size, extra = divmod(n, k)
    tiles = []
    for t in range(1, k + 1):
        tiles += [t] * (size + (t <= extra))
    return tiles


@pytest.mark.parametrize("n", [3, 7, 10, 11, 103, 5000])
def test_rank_and_tiles_equal_the_one_task_windows(spark, many_partitions, n):
    rows = _values(n, max(2, n // 5))
    df = spark.createDataFrame(rows, "k bigint, v bigint")
    ranked = with_rank(df, F.desc("v"), F.col("k"))
    got = ranked.select("k", "rank", "n", *[tile_of(F.col("rank"), F.col("n"), t).alias(f"t{t}") for t in (5, 10)])
    got = {r.k: r for r in got.collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for t in (5, 10):
        assert [got[k][f"t{t}"] for k, _ in order] == _ntile(n, t)
    assert [got[k]["rank"] for k, _ in order] == list(range(1, n + 1))
    assert {r.n for r in got.values()} == {n}


def test_one_value_for_all_rows_is_still_split_and_ranked(spark, many_partitions):
    df = spark.range(1000).withColumn("v", F.lit(0))
    ranked = with_rank(df, F.col("v"), F.col("id")).collect()
    assert sorted((r.id, r["rank"]) for r in ranked) == [(i, i + 1) for i in range(1000)]


def test_group_rank_with_a_group_over_many_partitions(spark, many_partitions):
    rows = [("hot", i) for i in range(900)] + [("cold", i) for i in range(50)] + [(None, i) for i in range(7)]
    df = spark.createDataFrame(rows, "g string, k bigint")
    got = {(r.g, r.k): (r["rank"], r.n) for r in with_group_rank(df, ["g"], F.col("k")).collect()}
    sizes = {"hot": 900, "cold": 50, None: 7}
    assert got == {(g, k): (k + 1, sizes[g]) for g, k in rows}


def _quantile_rows(kind, n=997):
    rnd = random.Random(kind)
    draw = {
        "even": lambda i: rnd.uniform(-100, 100),
        # Far apart values: bins of equal width put nearly all in the first one again and again.
        "steep": lambda i: 10.0 ** rnd.uniform(-12, 12),
        "ties": lambda i: float(rnd.choice([1, 1, 1, 2, 5])),
        "one": lambda i: 7.25,
        "ends": lambda i: rnd.choice([-1.7e308, 1.7e308, 0.0, 1e-300]),
    }[kind]
    return [(i, ["a", "b", None][i % 3], draw(i), None if i % 4 else float(i)) for i in range(n)]


@pytest.mark.parametrize("kind", ["even", "steep", "ties", "one", "ends"])
@pytest.mark.parametrize("bins, few", [(4096, 2048), (4, 3)])
def test_grouped_quantiles_equal_numpy(spark, monkeypatch, kind, bins, few):
    monkeypatch.setattr(selection, "BINS", bins)
    monkeypatch.setattr(selection, "FEW_ROWS", few)
    rows = _quantile_rows(kind, 997 if few > 3 else 200)
    df = spark.createDataFrame(rows, "k bigint, g string, x double, y double").repartition(5).cache()
    probs = {f"x{int(100 * p)}": ("x", p) for p in (0.0, 0.25, 0.5, 0.9, 0.95, 1.0)}
    got = grouped_quantiles(df, ["g"], {"x": F.col("x"), "y": F.col("y")}, {**probs, "y50": ("y", 0.5)}).collect()
    assert {r.g for r in got} == {"a", "b", None}
    for r in got:
        xs = sorted(x for _, g, x, _ in rows if g == r.g)
        ys = [y for _, g, _, y in rows if g == r.g and y is not None]
        for name, (_, p) in probs.items():
            low, part = divmod((len(xs) - 1) * p, 1)
            want = xs[int(low)] + (xs[min(int(low) + 1, len(xs) - 1)] - xs[int(low)]) * part
            assert r[name] == want or r[name] == pytest.approx(want, rel=1e-12), (kind, name)
        assert r.y50 == pytest.approx(np.quantile(ys, 0.5))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, x double")
    got = grouped_quantiles(df, ["g"], {"x": F.col("x")}, {"m": ("x", 0.5)}).collect()
    assert [(r.g, r.m) for r in got] == [("b", 2.0)]
    assert grouped_quantiles(df.limit(0), ["g"], {"x": F.col("x")}, {"m": ("x", 0.5)}).collect() == []


def test_no_row_is_sorted_or_shuffled_for_a_quantile(spark):
    df = spark.range(200_000).withColumn("x", F.rand(1)).withColumn("g", F.lit("a"))
    written = []
    real = selection.stage

    def kept(frame, label):
        out = real(frame, label)
        written.append(out.count())
        return out

    selection.stage = kept
    try:
        got = grouped_quantiles(df, ["g"], {"x": F.col("x")}, {"m": ("x", 0.5), "h": ("x", 0.99)}).first()
    finally:
        selection.stage = real
    assert abs(got.m - 0.5) < 0.01 and abs(got.h - 0.99) < 0.01
    assert max(written) <= 4


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_with_ties_over_many_partitions(spark, many_partitions, descending):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([rnd.randrange(-50, 5000), 7, 7, 7])) for _ in range(3000)]
    df = spark.createDataFrame([*rows, ("a", None)], "g string, v bigint").repartition(6)
    got = {(r.g, r.v): tuple(r)[2:] for r in running_by_value(df, ["g"], "v", descending).collect()}
    assert set(got) == set(rows)
    for (g, v), (n, before_n, before_sum, total_n, total_sum) in got.items():
        mine = [x for h, x in rows if h == g]
        before = [x for x in mine if (x > v if descending else x < v)]
        assert (n, before_n, before_sum) == (mine.count(v), len(before), sum(before))
        assert (total_n, total_sum) == (len(mine), sum(mine))


def test_running_totals_without_groups_equal_the_one_task_window(spark, many_partitions):
    df = spark.range(5000).withColumn("v", F.col("id") * 37 % 211)
    got = {r.v: (r.before_n, r.before_sum) for r in running_by_value(df, [], "v").collect()}
    assert len(got) == 211 and got[0] == (0, 0)
    for v, (n, total) in got.items():
        assert (n, total) == (sum(1 for i in range(5000) if i * 37 % 211 < v), sum(i * 37 % 211 for i in range(5000) if i * 37 % 211 < v))
    parts = running_by_value(df, [], "v").agg(*[F.sum(rows_between(F.lit(k * 500), F.lit(k * 500 + 500))).alias(f"p{k}") for k in range(10)]).first()
    assert tuple(parts) == (500,) * 10
    assert running_by_value(df.limit(0), [], "v").collect() == []
