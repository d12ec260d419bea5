"""Run a registered query and its SQL on the same tables and compare them whole."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def _rows(table: pa.Table) -> Counter:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return Counter(tuple(_norm(v) for v in row) for row in zip(*data))


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs; empty when names, types and all rows agree."""
    got = spark_df.toArrow()
    want = con.sql(sql).to_arrow_table()
    out = []
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"]
    for c in got.column_names:
        a, b = str(got.schema.field(c).type), str(want.schema.field(c).type)
        if a.replace("large_", "") != b.replace("large_", ""):
            out.append(f"type of {c}: {a} != {b}")
    left, right = _rows(got), _rows(want)
    if left != right:
        out.append(f"rows {got.num_rows} vs {want.num_rows}, only Spark {list((left - right).items())[:3]},"
                   f" only SQL {list((right - left).items())[:3]}")
    return out


def main(sf_dir: str, *names: str) -> int:
    import __spark_entry__ as entry
    from merchlens.session import local_session

    # SHUFFLE_PARTITIONS=200 runs with Spark's own default instead.
    spark = local_session(shuffle_partitions=int(os.environ.get("SHUFFLE_PARTITIONS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in names or queries:
        start = time.time()
        try:
            if key in oracle:
                diff = differences(queries[key](spark, sf_dir), con, oracle[key])
            else:
                diff = [] if queries[key](spark, sf_dir).toArrow().num_rows else ["no rows"]
                key += " (rows only)"
        except Exception as e:  # noqa: BLE001 - report and go on
            diff = [str(e)[:1500]]
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {key} {time.time() - start:.1f}s {diff or ''}", flush=True)
    print("bad", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
