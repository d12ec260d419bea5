"""Publish a table as its next version, or leave the one before as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.schema import TABLES
from merchlens.session import run_together
from merchlens.sources import files
from merchlens.sources.star import MONTH, Star, stored_form, table_path
from merchlens.sources.versions import ConcurrentPublish, Layer, Version, collect, commit, current, last_number, new_folder

# Reports read facts by period and the snapshot at single month ends, so facts are stored by month.
DATED = {
    "fact_orders": "order_date_key",
    "fact_order_lines": "order_date_key",
    "fact_returns": "return_date_key",
    "fact_customer_monthly_snapshot": "snapshot_month_date_key",
}


def publish_table(
    df: DataFrame, root: str, name: str, fmt: str = "parquet", expected: int | None = None, keep: int = 2
) -> int:
    """Write ``df`` as a new version of the table, count it back, then let readers see it.

    An empty or (with ``expected``) wrongly sized result raises, as does every step that fails, and readers go on
    with the version before; if another writer has published meanwhile, ``ConcurrentPublish`` is raised. Of earlier
    versions the last ``keep - 1`` stay for readers that have them open. Returns the number of rows published.
    """
    return _publish(df, root, name, fmt, expected, keep, None)


def publish_months(df: DataFrame, root: str, name: str, since: int, keep: int = 2) -> int:
    """Publish the months from ``since`` (199503) on anew; those before are read from where they are.

    ``df`` holds the new months only. Later months of the version before are no longer read. Returns the rows of the
    whole table.
    """
    return _publish(df, root, name, "parquet", None, keep, since)


def _publish(df: DataFrame, root: str, name: str, fmt: str, expected: int | None, keep: int, since: int | None) -> int:
    spark = df.sparkSession
    table = table_path(root, name, fmt)
    old = current(spark, table) if since is not None else None
    number = last_number(spark, table) + 1
    folder = new_folder(table, number)
    by = MONTH if fmt == "parquet" and name in DATED else None
    if since is not None and not (by and old and old.partition_by == by):
        raise ValueError(f"{name} has no months to append to")
    try:
        rows, parts = _write(df, folder, fmt, DATED[name] if by else None)
        if rows == 0 or (expected is not None and rows != expected):
            raise ValueError(f"{name}: {rows} rows written, {'some' if expected is None else expected} expected")
        layers: tuple[Layer, ...] = ()
        if since is not None:
            if min(parts) < since:
                raise ValueError(f"{name}: rows of {min(parts)} among months from {since}")
            kept = {m: n for m, n in old.parts.items() if m < since}
            layers = (*_before(old.read_from(), since), Layer(folder, since, None))
            rows, parts = rows + sum(kept.values()), kept | parts
        commit(spark, table, Version(number, folder, rows, by, parts, layers))
    except BaseException as e:
        # A commit that failed half-way may have been seen by readers, so only what is certainly unnamed goes.
        if isinstance(e, (ValueError, ConcurrentPublish)):
            files.remove(spark, folder)
        raise
    collect(spark, table, keep)
    return rows


def _before(layers: tuple[Layer, ...], month: int) -> list[Layer]:
    """Layers cut to the months before one."""
    cut = [Layer(x.folder, x.first, month - 1 if x.last is None else min(x.last, month - 1)) for x in layers]
    return [x for x in cut if x.first is None or x.first <= x.last]


def _write(df: DataFrame, folder: str, fmt: str, date_key: str | None) -> tuple[int, dict[int, int] | None]:
    """Write a version's files and count them as stored, by month where they are."""
    if date_key:
        # Rebalancing keeps files of a month together and splits a large month.
        df = df.withColumn(MONTH, F.floor(F.col(date_key) / 100).cast("int")).hint("rebalance", MONTH)
    writer = df.write.format(fmt)
    if date_key:
        writer = writer.partitionBy(MONTH)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(folder)
    reader = df.sparkSession.read.schema(df.schema).format(fmt)
    stored = (reader.option("header", True) if fmt == "csv" else reader).load(folder)
    if not date_key:
        return stored.count(), None
    parts = {r[0]: r[1] for r in stored.groupBy(MONTH).count().collect()}
    return sum(parts.values()), parts


def publish_star(star: Star, root: str, tables: tuple[str, ...] = TABLES, fmt: str = "parquet") -> dict[str, int]:
    """Publish the named tables of ``star``; returns the rows of each."""
    rows = run_together([lambda t=t: publish_table(stored_form(star, t), root, t, fmt) for t in tables])
    return dict(zip(tables, rows))
