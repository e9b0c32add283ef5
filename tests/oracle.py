"""Compares a query with its oracle SQL: columns, row count and every value, in any order.

Run as a script for all queries: python tests/oracle.py [scale folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got_columns, got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(entry.oracle_sql()[name])
    want_columns, want = sorted_rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} against {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main(sf_dir: str, names: list[str]) -> int:
    from conftest import session

    spark, con, failures = session(), connect(sf_dir), 0
    for name in names or entry.core_queries():
        start = time.time()
        try:
            verdict = compare(spark, con, sf_dir, name)
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(verdict)
        print(f"{'ok  ' if not verdict else 'FAIL'} {name} {time.time() - start:.1f}s {verdict}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    code = main(folder, sys.argv[2:])
    sys.stdout.flush()
    os._exit(bool(code))
