"""Small tables for the operators, and their SQL on the same rows."""

from __future__ import annotations

import tempfile

import duckdb

DOCS = "doc_id long, text string, lang string, source string, n_chars long, secrets string, size string, kept string"


def docs_table(spark, rows):
    """Documents from (doc_id, text, lang, source), with columns whose names clash with results."""
    full = [(i, t, a, s, None if t is None else len(t), "x", "y", "z") for i, t, a, s in rows]
    return spark.createDataFrame(full, DOCS)


def sql_rows(sql: str, **tables):
    """The query's columns and rows over frames written as Parquet."""
    con = duckdb.connect()
    for name, frame in tables.items():
        path = tempfile.mkdtemp(prefix="orderlens-sql-")
        frame.write.mode("overwrite").parquet(path)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def same(frame, columns, rows) -> None:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    want = sorted(repr([r[i] for i in order]) for r in rows)
    names = sorted(frame.columns)
    assert names == sorted(columns)
    got = sorted(repr([r[c] for c in names]) for r in frame.collect())
    assert got == want


def words(text):
    return (text or "").encode().lower().split()
