"""The registered queries: against SQL, or against brute force on the smallest tables."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import test_ngram_join
import test_ngram_lm
import test_packing
import test_secrets
import test_suffix_dedup
from orderlens.llm import ann, queries
from support import same

TABLES = ("documents", "pages", "conversations", "embeddings", "benchmark", "labels")


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


def rows_of(sf, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf, name):
    same(queries.QUERIES[name](spark, sf), *rows_of(sf, queries.ORACLE_SQL[name]))


def documents(sf):
    return rows_of(sf, "SELECT doc_id, text FROM documents")[1]


def test_secret_scan(spark, sf):
    texts = dict(documents(sf))
    rows = queries.QUERIES["op1_secret_scan"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = test_secrets.base_by_hand(texts[r.doc_id] or "")
        assert r.n_assign + r.n_access + r.n_hex == len(base)
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))


def test_packing_of_documents(spark, sf):
    rows = queries.QUERIES["op2_pack_sequences"](spark, sf).collect()
    used = test_packing.check_packing(rows, documents(sf))
    assert used * 2048 <= 1.01 * sum(r.length for r in rows) + 2048


def test_language_scores(spark, sf):
    got = sorted((str(r[0]), *r[1:]) for r in queries.QUERIES["op5_score_language"](spark, sf).collect())
    want = test_ngram_lm.by_hand(documents(sf), 2, test_ngram_lm.rounded)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_near_duplicates(spark, sf):
    got = sorted(repr(tuple(r)) for r in queries.QUERIES["op6_ngram_jaccard"](spark, sf).collect())
    assert got == test_ngram_join.by_hand(documents(sf))


def test_nearest_vectors(spark, sf):
    rows = rows_of(sf, "SELECT vec_id, embedding FROM embeddings")[1]
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    got = {}
    for r in queries.QUERIES["op9_nearest_vectors"](spark, sf).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(got) == {i for i in ids if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[ids.index(q)]) ** 2).sum(1))
        best = [ids[i] for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        hits += len(found.keys() & set(best))
        assert all(abs(d[ids.index(v)] - s) < 1e-12 for v, s in found.items())
    assert hits >= 0.9 * 10 * len(got)


def test_nearest_vectors_with_learned_partitions(spark):
    """2,000 vectors have parts: recall@10 of every query against brute force over the whole table."""
    folder = "/root/testdata/sf0.1"
    rows = rows_of(folder, "SELECT vec_id, embedding FROM embeddings")[1]
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    assert ann.parts_for(len(rows)) > 1
    got = {}
    for r in queries.QUERIES["op9_nearest_vectors"](spark, folder).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits, asked = 0, ids[ids % 100 == 0]
    for q in asked:
        d = ((x - x[ids == q][0]) ** 2).sum(1)
        best = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        hits += len(got.get(q, set()) & set(best))
    print(f"recall {hits} of {10 * len(asked)}")
    assert hits >= 0.9 * 10 * len(asked)


def test_repeated_strings(spark, sf):
    got = sorted((tuple(r) for r in queries.QUERIES["op12_suffix_dedup"](spark, sf).collect()), key=repr)
    assert got == test_suffix_dedup.by_hand(documents(sf), 400)
