from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from orderlens.llm import blocks, ngram_lm
from support import docs_table, words

END = b"\n"


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    follows = {w: rng.sample(vocabulary, 4) for w in vocabulary}

    def talk(length):
        w = rng.choice(vocabulary)
        out = [w]
        for _ in range(length):
            w = rng.choice(follows[w]) if rng.random() < 0.8 else rng.choice(vocabulary)
            out.append(w if rng.random() < 0.97 else f"rare{rng.randint(0, 10**6)}")
        return " ".join(out)

    rows = [(i, talk(rng.randint(0, 60))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t"), (None, "w1 W2 É"), (None, None), (4, rows[4][1]), (n + 3, "w1 " * 30_000)]


def fold(name):
    return zlib.crc32(("" if name is None else str(name)).encode()) % 10


def tokens(text):
    return [*words(text), END]


def by_hand(rows, order, cells=lambda p: p):
    """Every score from plain dictionaries; `cells` rounds the estimates that the weights are learned on."""

    def grams(row_filter):
        counts = [Counter() for _ in range(order)]
        for name, text in rows:
            if row_filter(fold(name)):
                t = [("start",)] * (order - 1) + tokens(text)
                for i in range(order - 1, len(t)):
                    for k in range(order):
                        counts[k][tuple(t[i - k : i + 1])] += 1
        return counts

    def estimates(counts, docs, t, i):
        found, context = [], 0
        for k in range(order):
            gram = tuple(t[i - k : i + 1])
            before = gram[:-1]
            if not before:
                context = sum(counts[0].values())
            else:
                context = docs if all(b == ("start",) for b in before) else counts[k - 1][before]
            found.append(counts[k][gram] / context if context else 0.0)
        return found, context

    trained, rest = grams(lambda f: f != 0), grams(lambda f: f > 1)
    docs = [sum(fold(n) > least for n, _ in rows) for least in (0, 1)]
    uniform = 1 / (len(trained[0]) + 1)
    events = []
    for name, text in rows:
        if fold(name) == 1:
            t = [("start",)] * (order - 1) + tokens(text)
            for i in range(order - 1, len(t)):
                found, context = estimates(rest, docs[1], t, i)
                events.append((context.bit_length(), *map(cells, found)))

    def em(part):
        p = np.array([(uniform, *e[1:]) for e in part])
        w = np.full(order + 1, 1 / (order + 1))
        for _ in range(ngram_lm.SWEEPS):
            share = p * w
            w = (share / share.sum(1, keepdims=True)).mean(0)
        w = np.maximum(w, ngram_lm.LEAST_WEIGHT)
        return w / w.sum()

    weights = {b: em([e for e in events if e[0] == b]) for b in {e[0] for e in events}}
    pooled = em(events)
    n, v = sum(trained[0].values()), len(trained[0])
    out = []
    for name, text in rows:
        t = [("start",)] * (order - 1) + tokens(text)
        score = base = 0.0
        for i in range(order - 1, len(t)):
            found, context = estimates(trained, docs[0], t, i)
            w = weights.get(context.bit_length(), pooled)
            score += math.log10(w[0] * uniform + sum(a * b for a, b in zip(w[1:], found)))
            base += math.log10((trained[0][(t[i],)] + 0.1) / (n + 0.1 * (v + 1)))
        known = sum(trained[0][(x,)] > 0 for x in tokens(text))
        out.append((str(name), fold(name) == 0, len(tokens(text)), known, n, base, score))
    return sorted(out)


def rounded(p):
    return 2.0 ** (round(ngram_lm.GRID * math.log2(p)) / ngram_lm.GRID) if p else 0.0


@pytest.mark.parametrize("order", (1, 2, 3))
def test_against_dictionaries(spark, order, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", 700)
    rows = corpus(order)
    table = docs_table(spark, [(i, t, "en", "s") for i, t in rows]).repartition(3)
    got = sorted((str(r[0]), *r[1:]) for r in ngram_lm.score(table, order=order).collect())
    want = by_hand(rows, order, rounded)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_rounding_the_events_hardly_matters():
    rows = corpus(8)
    exact, near = by_hand(rows, 2), by_hand(rows, 2, rounded)
    assert sum(r[6] for r in near) == pytest.approx(sum(r[6] for r in exact), rel=2e-3)


def test_mixture_beats_the_base_on_held_out_texts(spark):
    rows = [(i, t, "en", "s") for i, t in corpus(9, 600)]
    held = ngram_lm.score(docs_table(spark, rows)).filter("held_out").toPandas()
    assert len(held) > 30 and held["score"].sum() > held["base_score"].sum() + 0.1 * abs(held["base_score"].sum())


def test_weights_are_distributions():
    events = pd.DataFrame({"bucket": [3, 3, 5], "e1": [-8, -20, -9], "e2": [-2, ngram_lm.NEVER, -1], "n": [5, 2, 9]})
    weights = ngram_lm.learned_weights(events, 2, 0.001)
    assert np.allclose(weights.sum(1), 1) and (weights > 0).all()


def test_small_tables(spark):
    assert ngram_lm.score(docs_table(spark, [])).count() == 0
    held = next(i for i in range(100) if fold(i) == 0)
    row = ngram_lm.score(docs_table(spark, [(held, "a b", "en", "s")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.score == row.base_score == 0.0
