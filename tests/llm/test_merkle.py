"""The Merkle manifest against a tree built plainly in memory."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from orderlens.llm import merkle
from support import docs_table, same, sql_rows

LOWER = str.maketrans(merkle.LETTERS, merkle.LETTERS.lower())


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root, and for each node its (left siblings, right siblings) level by level."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 16] for k in range(0, len(nodes), 16)]
        for k, place in enumerate(at):
            run = runs[place // 16]
            steps[k].append((run[: place % 16], run[place % 16 + 1 :]))
            at[k] = place // 16
        nodes = [h(*run) for run in runs]
    return nodes[0], steps


def by_hand(rows):
    """Audit rows for (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for i, text, lang, source, n in rows:
        hit = text is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        first = leaf(i, source, lang, n, text)
        groups.setdefault(source, []).append((i, first, leaf(i, source, lang, n, text.translate(LOWER)) if hit else first))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = tree([r[1] for r in groups[s]])
    root, above = tree([trees[s][0] for s in names]) if names else (None, [])
    out = []
    for s, upper in zip(names, above):
        for (i, first, altered), steps in zip(groups[s], trees[s][1]):
            folded, path = altered, steps + upper
            for left, right in path:
                folded = h(*left, folded, *right)
            proof = h(*(d for left, right in path for d in (*left, *right)))
            out.append((i, first, trees[s][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in merkle.audit(frame).collect()), key=repr)


def check(spark, rows):
    frame = docs_table(spark, rows)
    assert found(frame) == by_hand([(i, t, a, s, None if t is None else len(t)) for i, t, a, s in rows])
    return frame


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 600])
def test_sizes_around_runs_and_blocks(spark, n):
    rows = [(k, f"Text {k} ÄÖ", "en", "a") for k in range(n)] + [(k, f"B {k}", "de", "b") for k in range(3)]
    check(spark, rows)


def test_many_groups(spark):
    check(spark, [(k, "Some Text", None, f"s{k % 300}") for k in range(700)])


def test_odd_rows_and_sql(spark):
    rows = [(k, "X" * k, "en", None) for k in range(20)] + [(None, "Null Id", None, "a"), (None, None, None, "a")]
    rows += [(5, "Copy", "en", "b")] * 40 + [(5, "Other", "en", "b"), (5, None, "en", ""), (7, "", "", "")]
    rows += [(9, "A" * 100_000, "en", "ü"), (-3, "Minus", "en", "z")]
    frame = check(spark, rows)
    got = merkle.audit(frame.drop("secrets"))
    same(got, *sql_rows(merkle.oracle_sql(3, 2), documents=frame))
    assert merkle.audit(frame.limit(0)).collect() == []


def test_a_row_that_is_repeated_fills_blocks(spark):
    rows = [(1, "same", "en", "a")] * 1500 + [(k, "x", "en", "a") for k in range(30)]
    check(spark, rows)


def test_witnesses_grow_as_siblings_arrive():
    digests = [hashlib.sha256(bytes([k])).digest() for k in range(40)]
    tree_ = merkle.Appender(2)
    for k, d in enumerate(digests):
        tree_.append(d)
        assert len(tree_.closed[0]) == (k + 1) // 16 and len(tree_.open[0]) == (k + 1) % 16 * 32
    root = tree_.finish()
    for k, d in enumerate(digests):
        path = merkle.witness(tree_.closed, k)
        assert merkle.folded(d, path) == root
        assert merkle.folded(digests[0], path) != root or k == 0


def test_nothing_else_in_the_table_matters(spark):
    rows = [(k, f"t{k}", "en", "a") for k in range(5)]
    frame = docs_table(spark, rows)
    extra = frame.withColumn("leaf", frame.text).withColumn("grp", frame.text).withColumn("root", frame.text)
    assert found(extra) == found(frame)
