"""Session settings and the shared scratch folder for staged tables."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("merchlens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Settings the jobs count on; all can be set on a running session.

    A join on a hot key is split even where the aggregate after it uses the same
    key: the aggregate's map side then runs on the split parts.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")


# Rows that shuffles carry in a few bytes unfold to many, such as the months of a customer, so a task reads this much at
# most; and files hold a table in a tenth of what it takes in memory, so a broadcast one is smaller than Spark's default.
_TASK_MB, _BROADCAST_MB, _SLICES = 4, 2, 800


def tune_tables(spark: SparkSession) -> None:
    """Settings of ``tune`` and those that keep the memory of a task, and of the driver, from growing with the tables.

    Shuffles are cut into many slices, which Spark puts together again up to the size a task is to read. Smaller
    sizes that the session has stay.
    """
    tune(spark)
    for key, mb in (("adaptive.advisoryPartitionSizeInBytes", _TASK_MB), ("autoBroadcastJoinThreshold", _BROADCAST_MB)):
        if _bytes(spark.conf.get(f"spark.sql.{key}")) > mb << 20:
            spark.conf.set(f"spark.sql.{key}", f"{mb}m")
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < _SLICES:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(_SLICES))


def _bytes(size: str) -> int:
    """A size as settings state it: 10485760b, 256k, 64MB."""
    number, unit = re.fullmatch(r"(-?\d+)([a-z]?)b?", size.strip().lower()).groups()
    return int(number) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit, 0)


def scratch_root(spark: SparkSession) -> str:
    """The folder staged tables go to.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a
    ``local`` master may fall back to a folder of its own machine; on a cluster
    executors could not see it, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="merchlens-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


# Folders of this process: those that staged tables lie in, and others, which go when it ends.
_staged: dict[str, SparkSession] = {}
_folders: dict[str, SparkSession] = {}


def _new_path(spark: SparkSession, label: str) -> str:
    if not _staged and not _folders:
        atexit.register(_leave)
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder in the shared scratch folder; it goes when the process ends."""
    path = _new_path(spark, label)
    _folders[path] = spark
    return path


# Settings of jobs that run lean: their shuffle files go when they end, and a join on several keys takes a side that is
# dealt by some of them as it is.
_LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
_lean_lock = threading.Lock()
# Of each session, how many jobs run lean just now, and the settings it had before.
_lean_now: dict[SparkSession, tuple[int, dict[str, str | None]]] = {}


@contextlib.contextmanager
def lean_jobs(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside take little disk; jobs side by side share the settings, and the last one puts them back."""
    with _lean_lock:
        n, before = _lean_now.get(spark, (0, {}))
        if n == 0:
            before = {k: spark.conf.get(k, None) for k in _LEAN}
            for k, v in _LEAN.items():
                spark.conf.set(k, v)
        _lean_now[spark] = n + 1, before
    try:
        yield
    finally:
        with _lean_lock:
            n, before = _lean_now.pop(spark)
            if n > 1:
                _lean_now[spark] = n - 1, before
            else:
                for k, v in before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df: DataFrame, label: str, lean: bool = False) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Later readers see stored rows, so row positions assigned by the writing job
    stay fixed, the lineage ends here, and a lost executor costs a re-read, not
    a re-run. The stored columns can still be pruned and filtered. The folder
    goes with ``unstage``, with ``clear_scratch`` or when the process ends.

    ``lean`` is for jobs that shuffle much: their shuffle files go as soon as the
    rows are stored, not when the driver next collects its garbage, and sides of
    a join that are dealt by some of its keys are not dealt again by all of them.
    """
    path = _new_path(df.sparkSession, label)
    with lean_jobs(df.sparkSession) if lean else contextlib.nullcontext():
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    _staged[path] = df.sparkSession
    return out


def together(df: DataFrame) -> DataFrame:
    """``df`` in as few parts as its size asks for.

    For rows that are staged and small beside those they were made from, so that
    files do not come one for each task. On a local disk without Hadoop's native
    library an executor starts up to three processes for each file it writes,
    each of which counts as large as the executor for a moment.
    """
    return df.hint("rebalance")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def unstage(df: DataFrame) -> None:
    """Remove the folder of a staged table that nothing will read any more."""
    path = getattr(df, "_staged_at", None)
    if path in _staged:
        _delete(_staged.pop(path), path)


def clear_scratch() -> None:
    """Remove all staged tables of this process; results that still read them can no longer be computed."""
    _clear(_staged)


def _clear(paths: dict[str, SparkSession]) -> None:
    for path in list(paths):
        spark = paths.pop(path)
        # At the end of the process the session may be gone already.
        with contextlib.suppress(Exception):
            _delete(spark, path)


def _leave() -> None:
    _clear(_staged)
    _clear(_folders)


def run_together(jobs: Sequence[Callable[[], object]], at_once: int = 6) -> list:
    """Run independent Spark jobs side by side, so small ones do not queue up
    behind each other; results in the given order."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(lambda job: job(), jobs))
