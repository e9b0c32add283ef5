"""Repeated byte strings against a count of every string of the length."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from orderlens.llm import suffix_dedup
from support import docs_table


def by_hand(rows, length):
    """(id, bytes, removed, runs, digest of the rest), sorted, for (id, text)."""
    data = [(name, (text or "").encode()) for name, text in rows]
    seen = Counter(t[k : k + length] for _, t in data for k in range(len(t) - length + 1))
    out = []
    for name, t in data:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((name, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(frame, length):
    rows = suffix_dedup.digest(suffix_dedup.without_repeats(frame, length=length)).collect()
    return sorted(map(tuple, rows), key=repr)


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdeä") for _ in range(pick.randint(1, 9))) for _ in range(n))


def pasted(seed, copies):
    """Texts that share passages of every length around 48 bytes, at places of their own, some in one text twice."""
    pick, shared = random.Random(seed), [prose(100 + k, 12)[: 40 + k] for k in range(24)]
    rows = []
    for k in range(copies):
        parts = [p for _ in range(4) for p in (prose(1000 * seed + pick.randint(0, 10**6), 3), pick.choice(shared))]
        rows.append((k, "".join(parts)))
    return rows


@pytest.mark.parametrize("length", [48, 100])
def test_passages_at_odd_places(spark, monkeypatch, length):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 2000)
    rows = pasted(7, 60) + [(100, prose(1, 80)), (101, prose(1, 80)[3:]), (102, prose(1, 80)[:-5]), (103, prose(2, 99) * 3)]
    got = found(docs_table(spark, [(i, t, "en", "a") for i, t in rows]), length)
    assert got == by_hand(rows, length) and sum(r[2] for r in got) > 0


def test_runs_of_one_letter_and_periods(spark):
    rows = [(1, "a" * 1000), (2, "b" * 48), (3, "b" * 49), (4, "xy" * 60), (5, "q" + "xyz" * 40), (6, "ab" * 24), (7, "c" * 47)]
    assert found(docs_table(spark, [(i, t, "en", "a") for i, t in rows]), 48) == by_hand(rows, 48)


def test_odd_rows(spark):
    text = prose(3, 40)
    rows = [(None, text), (1, None), (1, ""), (2, text), (2, text), (3, "short"), (4, prose(4, 60_000)), (5, prose(4, 9_000))]
    frame = docs_table(spark, [(i, t, None, None) for i, t in rows])
    got = {(r[0], r[1]): r for r in found(frame, 64)}
    whole = len(prose(4, 9_000).encode())
    assert got[(5, whole)][2] == whole and got[(4, len(prose(4, 60_000).encode()))][2] >= whole
    assert found(frame.filter("doc_id < 4 or doc_id is null"), 64) == by_hand([r for r in rows if r[0] not in (4, 5)], 64)
    assert found(frame.limit(0), 64) == []


def test_spans_are_what_is_missing(spark):
    rows = pasted(9, 20)
    texts = {i: t.encode() for i, t in rows}
    for r in suffix_dedup.without_repeats(docs_table(spark, [(i, t, "en", "a") for i, t in rows]), length=48).collect():
        gone = {k for s in r.spans for k in range(s.start, s.end)}
        assert bytes(r.kept) == bytes(b for k, b in enumerate(texts[r.doc_id]) if k not in gone)


def test_anchors_are_the_same_wherever_a_string_stands():
    text = np.frombuffer(prose(5, 300).encode(), np.uint8)
    one = suffix_dedup.nearest_words(text, 96)
    assert (suffix_dedup.nearest_words(text[50:], 96) == one[50:] - 50).all()


def test_too_short_a_length():
    with pytest.raises(ValueError):
        suffix_dedup.window_for(16)


@pytest.mark.parametrize("clash", [False, True])
def test_keys_are_told_apart_by_both_parts_in_one_sort(monkeypatch, clash):
    """The slow sort by both parts runs only where first parts clash."""
    calls, sort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: calls.append(1) or sort(keys))
    pick = np.random.default_rng(3)
    high = pick.integers(0, 50, 400).astype(np.uint64) << np.uint64(40)
    low = (pick.integers(0, 3, 400) if clash else high >> np.uint64(41)).astype(np.uint32)
    marks = pick.integers(0, 9, 400) == 0
    highs, lows, n, marked, place = suffix_dedup._distinct((high, low, marks))
    keys = list(zip(high.tolist(), low.tolist()))
    assert list(zip(highs.tolist(), lows.tolist())) == sorted(set(keys))
    assert [keys.count(k) for k in sorted(set(keys))] == n.tolist()
    assert [any(m for k, m in zip(keys, marks) if k == one) for one in sorted(set(keys))] == marked.tolist()
    assert [sorted(set(keys))[p] for p in place] == keys
    assert bool(calls) == clash


def test_no_keys():
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, bool)
    assert [len(x) for x in suffix_dedup._distinct(none)] == [0] * 5
