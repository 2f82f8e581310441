"""Run registered queries next to their SQL and compare the results.

    python -m tests.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import os
import sys
import tempfile
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple(map(repr, t)))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = Path(folder) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = _rows(df.columns, df.collect())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    if len(got) != len(want):
        return f"rows {len(got)} instead of {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows, first: {cells[:4]}"
    return None


def main(folder: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as registry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("COMPARE_PARTITIONS", "8"))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))  # one machine
        # Small tables: joins are shuffled, so that all cores work on them.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    sql = registry.oracle_sql()
    failed = 0
    for name, run in registry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                why = difference(df, con, sql[name])
            else:
                why = f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            why = f"ERROR {type(e).__name__}: {str(e)[:30000]}"
        ok = why is None or why.startswith("rows only")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t:.1f}s {why or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
