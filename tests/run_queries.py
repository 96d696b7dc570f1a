"""Run registered queries against their SQL in DuckDB: ``python tests/run_queries.py [sf] [name ...]``."""

import os
import sys
import tempfile
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def session(cpus: int = 8, partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def compare(columns_a, rows_a, columns_b, rows_b) -> str:
    """Empty when both results have the same columns and the same multiset of rows."""
    if sorted(columns_a) != sorted(columns_b):
        return f"columns {sorted(columns_a)} != {sorted(columns_b)}"
    order_a = [columns_a.index(c) for c in sorted(columns_a)]
    order_b = [columns_b.index(c) for c in sorted(columns_b)]
    key = lambda r: repr(r)
    a = sorted((tuple(cell(r[i]) for i in order_a) for r in rows_a), key=key)
    b = sorted((tuple(cell(r[i]) for i in order_b) for r in rows_b), key=key)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; first {a[:1]} / {b[:1]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y or [type(v) for v in x] != [type(v) for v in y]]
    if bad:
        return f"{len(bad)} rows differ; {sorted(columns_a)} first {bad[0][0]} / {bad[0][1]}"
    return ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark, con = session(), duck(folder)
    todo, sql = queries(), oracle_sql()
    names = sys.argv[2:] or list(todo)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = todo[name](spark, folder)
            rows = df.collect()
            took = time.time() - start
            if name not in sql:
                print(f"rows {name}: {len(rows)} rows {took:.1f}s {rows[:2] if len(sys.argv) > 2 else ''}", flush=True)
                continue
            cur = con.execute(sql[name])
            problem = compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall())
        except Exception as exc:  # noqa: BLE001
            problem, took, rows = f"{type(exc).__name__}: {str(exc)[:600]}", time.time() - start, []
            if len(sys.argv) > 3:
                traceback.print_exc()
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name}: {len(rows)} rows {took:.1f}s {problem}", flush=True)
    print("failed:", failed, "of", len(names))


if __name__ == "__main__":
    main()
