"""Run every registered query next to its SQL and compare schema names and values.

python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from stationflow.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, int, float]:
    started = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = df.collect()
    took = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "no sql", len(got), took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    types = {d[0]: str(d[1]) for d in cur.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}", len(got), took
    bad = []
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for column, kind in df.dtypes:
        if same.get(kind, "?") != types[column]:
            bad.append((column, kind, types[column]))
    if bad:
        return f"types {bad}", len(got), took
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"values differ: {len(a)} / {len(b)} rows, {diff}", len(got), took
    return "ok", len(got), took


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(entry.queries())
    spark = local_session("8", memory="8g")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        try:
            verdict, n, took = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            verdict, n, took = f"error {str(e)[:1500]}", 0, 0.0
        failed += verdict not in ("ok", "no sql")
        print(f"{name:26} {n:8} {took:7.2f}s  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
