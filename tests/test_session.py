"""The settings that tables are read with."""

import time

import pytest
from pyspark.sql import functions as F

from merchlens import session
from merchlens.session import _bytes, stage, together, tune_tables

KEYS = (
    "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
)


@pytest.fixture()
def settings(spark):
    session = spark.newSession()
    for key in KEYS:
        session.conf.unset(key)
    return session


def test_sizes():
    assert [_bytes(s) for s in ("10485760b", "256k", "64MB", "7", "-1")] == [10485760, 256 << 10, 64 << 20, 7, -1]


def test_what_spark_thinks_small_does_not_fill_the_driver(settings):
    tune_tables(settings)
    assert _bytes(settings.conf.get(KEYS[0])) <= 2 << 20


@pytest.mark.parametrize("size", ["256k", "-1"])
def test_a_smaller_limit_stays(settings, size):
    settings.conf.set(KEYS[0], size)
    tune_tables(settings)
    assert settings.conf.get(KEYS[0]) == size


def test_a_task_reads_little_whatever_the_tables_size(settings):
    settings.conf.set("spark.sql.shuffle.partitions", "8")
    tune_tables(settings)
    rows = settings.range(0, 3_000_000, 1, 8).selectExpr("hash(id) AS k", "uuid() AS text").groupBy("k").agg({"text": "max"})
    parts = rows.rdd.getNumPartitions()
    # Some 80 MB are shuffled; they used to come in 8 parts.
    assert parts > 12


def test_small_rows_are_staged_in_few_files(spark):
    rows = spark.range(0, 4000, 1, 40).selectExpr("id", "repeat('x', 1000) AS text")
    lengths = rows.selectExpr("id", "length(text) AS n")
    assert len(stage(lengths, "lengths").inputFiles()) == 40
    staged = stage(together(lengths), "lengths")
    assert len(staged.inputFiles()) <= 4
    assert sorted(map(tuple, staged.collect())) == [(i, 1000) for i in range(4000)]


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if blocks.apply(i).isShuffle()}


def test_a_lean_stage_leaves_no_shuffle_files_and_no_settings(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("k"), "id")
    before, held = _shuffle_files(spark), {k: spark.conf.get(k, None) for k in session._LEAN}
    stored = session.stage(rows.groupBy("k").agg(F.max("id").alias("id")), "lean", lean=True)
    left = _shuffle_files(spark) - before
    for _ in range(50):  # the files go in the background
        if not left:
            break
        time.sleep(0.1)
        left = _shuffle_files(spark) - before
    assert not left
    assert {k: spark.conf.get(k, None) for k in session._LEAN} == held
    assert stored.count() == 20_000


def test_lean_jobs_side_by_side_put_the_settings_back(spark):
    held = {k: spark.conf.get(k, None) for k in session._LEAN}
    jobs = [lambda i=i: session.stage(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), f"lean-{i}", lean=True) for i in range(6)]
    assert [df.count() for df in session.run_together(jobs)] == [7] * 6
    assert {k: spark.conf.get(k, None) for k in session._LEAN} == held
    with pytest.raises(Exception), session.lean_jobs(spark):
        raise ValueError
    assert {k: spark.conf.get(k, None) for k in session._LEAN} == held
