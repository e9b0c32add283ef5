"""The divergence audit against its SQL, and its parts against whole-number arithmetic in Python."""

from __future__ import annotations

import random

import numpy as np
import pytest

from orderlens.llm import divergence
from support import docs_table, same, sql_rows


def corpus(seed, n, langs=("en", "de"), sources=("a", "b", "c", "d")):
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abcdXYZäß") for _ in range(pick.randint(1, 4))) for _ in range(120)]
    rows = []
    for k in range(n):
        words = [vocabulary[min(int(pick.expovariate(0.05)), 119)] for _ in range(pick.randint(0, 40))]
        rows.append((k, pick.choice([" ", ", ", "-", " ", "1"]).join(words), pick.choice(langs), pick.choice(sources)))
    return rows


def check(spark, rows):
    frame = docs_table(spark, rows)
    got = divergence.audit(frame)
    same(got, *sql_rows(divergence.oracle_sql(), documents=frame))
    return got


def test_against_sql(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_TERMS", 20)
    monkeypatch.setattr(divergence, "HELD_TERMS", 50)
    assert check(spark, corpus(3, 150)).filter("part = 'term'").count() > 0


def test_odd_rows(spark):
    rows = corpus(4, 30) + [(None, None, None, None), (1, "", "", ""), (1, "Foo foo FOO", None, "a"), (1, "foo", None, "b")]
    rows += [(2, "123 !", "xx", "only"), (3, "word " * 50_000, "en", "a")] + [(4, "same same", "en", "copies")] * 5
    rows += [(5, "no kept term", "yy", s) for s in ("a", "b", None)]
    check(spark, rows)
    assert divergence.audit(docs_table(spark, []).limit(0)).collect() == []


def test_ranks_end_at_the_top(spark):
    frame = docs_table(spark, corpus(5, 200))
    rows = divergence.audit(frame, top=3).filter("part = 'term'").collect()
    assert {r["rank"] for r in rows} == {1, 2, 3}


@pytest.mark.parametrize("total", [0, 1, 10**6, 10**15])
def test_shares_are_exact(total):
    n = np.array([0, total // 3, total], np.int64)
    want = [1 + 10**9 * (int(k) + 1) // (total + 7) for k in n]
    assert divergence.shares(n, total, 7).tolist() == want


def test_merge_prices_both_ways():
    pick = random.Random(6)
    for _ in range(50):
        a, b = ({k: pick.randint(1, 9) for k in pick.sample(range(40), pick.randint(0, 30))} for _ in range(2))
        packed = [(np.array(sorted(x), np.int64), np.array([x[k] for k in sorted(x)], np.uint64)) for x in (a, b)]
        totals, kept = [sum(x.values()) for x in (a, b)], 40

        def share(x, k, total):
            return 1 + 10**9 * (x.get(k, 0) + 1) // (total + kept)

        want = [0, 0]
        for k in set(a) | set(b):
            p, q = share(a, k, totals[0]), share(b, k, totals[1])
            want[0] += (p - q) ** 2 // q
            want[1] += (p - q) ** 2 // p
        assert divergence.merged(*packed, *totals, kept) == (len(set(a) | set(b)), *want)
