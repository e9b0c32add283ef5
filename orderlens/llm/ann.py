"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph. The graph is cut into balanced parts, a small classifier learns
the parts of a vector's neighbours from the vector, and every vector of the table goes to its most probable part. A
query is compared, in full precision, with all vectors of its several most probable parts; how many is settled on
sample rows held out of the fit.

Only the sample (`SAMPLE` + `HELD_OUT` rows) and the counts per part (`MAX_PARTS`) reach the driver. Parts are split
into cells of bounded size on both sides, so one part with a third of all vectors is many tasks' work, and every copy
of a vector is compared.

Vectors that are null, empty, zero, or hold a null or non-finite component take no part, neither do those whose length is
not the most frequent one. Rows with a query's id are its own and no candidates for it. An empty table gives an empty
result. Other columns stay out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import written

# Bounds of the fit, documented in the README: rows of the sample, rows held out to settle the probes, parts.
SAMPLE, HELD_OUT, MAX_PARTS = 4096, 1024, 256
NEIGHBOURS = 10
TARGET_RECALL = 0.95
CELL_ROWS, CELL_QUERIES = 4096, 4096
BLOCK = 256


def usable(vectors: DataFrame, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part, as doubles."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0"
    )
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(finite).filter(F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == sizes[0][0]) if sizes else rows


def nearest(points: np.ndarray, queries: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Indexes of the k nearest points of each query; with `own` the queries are the points, themselves left out."""
    found, squares = [], (points**2).sum(1)
    for at in range(0, len(queries), BLOCK):
        block = queries[at : at + BLOCK]
        far = squares - 2 * block @ points.T
        if own:
            far[np.arange(len(block)), np.arange(at, at + len(block))] = np.inf
        k_here = min(k, far.shape[1] - 1) or 1
        near = np.argpartition(far, k_here - 1, axis=1)[:, :k_here]
        order = np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable")
        found.append(np.take_along_axis(near, order, 1))
    return np.concatenate(found)


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """Cuts the neighbour graph in halves again and again, each half holding as many points as the other.

    A half follows the graph's second eigenvector, by power iteration, cut at the median; then the pairs of points
    whose exchange removes most cut edges change sides.
    """
    n, k = graph.shape
    heads, tails = np.repeat(np.arange(n), k), graph.reshape(-1)
    heads, tails = np.concatenate([heads, tails]), np.concatenate([tails, heads])
    labels, rng = np.zeros(n, np.int64), np.random.default_rng(seed)
    for _ in range(int(math.log2(parts))):
        inner = labels[heads] == labels[tails]
        a, b = heads[inner], tails[inner]
        degree = np.maximum(np.bincount(a, minlength=n), 1)
        x = rng.standard_normal(n)
        sizes = np.bincount(labels)
        weight = np.bincount(labels, degree)
        for _ in range(60):
            x -= (np.bincount(labels, x * degree) / weight)[labels]
            x = 0.5 * x + 0.5 * np.bincount(a, x[b], minlength=n) / degree
            norm = np.sqrt(np.bincount(labels, x * x) / sizes)
            x /= np.maximum(norm, 1e-12)[labels]
        order = np.lexsort((x, labels))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - (np.cumsum(sizes) - sizes)[labels[order]]
        side = (rank >= (sizes[labels] + 1) // 2).astype(np.int64)
        for _ in range(8):
            other = np.bincount(a, side[a] != side[b], minlength=n)
            gain = 2 * other - np.bincount(a, minlength=n)
            moved = 0
            for part in range(len(sizes)):
                here = [np.flatnonzero((labels == part) & (side == s)) for s in (0, 1)]
                best = [m[np.argsort(-gain[m], kind="stable")] for m in here]
                pairs = min(map(len, best))
                better = int((gain[best[0][:pairs]] + gain[best[1][:pairs]] > 0).sum()) // 4
                for s in (0, 1):
                    side[best[s][:better]] = 1 - s
                moved += better
            if not moved:
                break
        labels = 2 * labels + side
    return labels


@dataclass
class Router:
    """One hidden layer; probabilities of the parts of a vector."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def parts(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x).argmax(1)

    def most_probable(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :n]


def train(points: np.ndarray, goals: np.ndarray, hidden=128, epochs=12, batch=256, rate=0.003, seed=11) -> Router:
    """Softmax regression through one hidden layer onto the distribution of parts, by Adam."""
    rng, (n, dims), parts = np.random.default_rng(seed), points.shape, goals.shape[1]
    mean = points.mean(0)
    scale = 1 / max(float((points - mean).std()), 1e-12)
    x = (points - mean) * scale
    weights = [
        rng.standard_normal((dims, hidden)) * math.sqrt(2 / dims),
        np.zeros(hidden),
        rng.standard_normal((hidden, parts)) * math.sqrt(1 / hidden),
        np.zeros(parts),
    ]
    first, second, step = [0 * w for w in weights], [0 * w for w in weights], 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            rows = order[at : at + batch]
            inside = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            out = inside @ weights[2] + weights[3]
            out = np.exp(out - out.max(1, keepdims=True))
            error = (out / out.sum(1, keepdims=True) - goals[rows]) / len(rows)
            back = (error @ weights[2].T) * (inside > 0)
            slopes = [x[rows].T @ back, back.sum(0), inside.T @ error, error.sum(0)]
            step += 1
            for w, g, m, s in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Router(mean, scale, *weights)


@dataclass
class Index:
    router: Router
    parts: int
    probes: int


def fit(sample: np.ndarray, held_out: np.ndarray, parts: int) -> Index:
    """Graph, parts, classifier, and the fewest probes that find enough of the held-out rows' neighbours."""
    graph = nearest(sample, sample, NEIGHBOURS, own=True)
    labels = balanced_parts(graph, parts)
    around = np.concatenate([graph, np.arange(len(sample))[:, None]], axis=1)
    goals = np.zeros((len(sample), parts))
    np.add.at(goals, (np.arange(len(sample))[:, None], labels[around]), 1 / around.shape[1])
    router = train(sample, goals)
    routed = router.parts(sample)
    truth = routed[nearest(sample, held_out, NEIGHBOURS, own=False)]
    ranked = router.most_probable(held_out, parts)
    depth = (ranked[:, None, :] == truth[:, :, None]).argmax(2)
    probes = next(p for p in range(1, parts + 1) if (depth < p).mean() >= min(TARGET_RECALL, (depth < parts).mean()))
    return Index(router, parts, probes)


def parts_for(rows: int) -> int:
    """A power of two that grows with the square root of the rows."""
    if rows < 1024:
        return 1
    return min(MAX_PARTS, 2 ** round(math.log2(max(2.0, math.sqrt(rows) / 6))))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def build(rows: DataFrame, n: int) -> Index | None:
    """Fits on the rows that a hash of the id puts first; None where one part is enough."""
    parts = parts_for(n)
    if parts == 1:
        return None
    chosen = rows.withColumn("h", F.xxhash64("vec_id")).orderBy("h", "vec_id").limit(SAMPLE + HELD_OUT).toPandas()
    x = _matrix(chosen["v"])
    cut = len(x) * SAMPLE // (SAMPLE + HELD_OUT)
    return fit(x[:cut], x[cut:], parts)


def _routed(rows: DataFrame, index: Index | None, probes: int) -> DataFrame:
    """(vec_id, v, part): a row for each of the most probable parts."""
    if index is None:
        return rows.withColumn("part", F.lit(0))

    def route(batches):
        for batch in batches:
            if len(batch):
                found = index.router.most_probable(_matrix(batch["v"]), probes)
                yield batch.assign(part=list(found.astype(np.int32)))

    found = rows.mapInPandas(route, "vec_id long, v array<double>, part array<int>")
    return found.select("vec_id", "v", F.explode("part").alias("part"))


def _top(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's k nearest of the rows, ties to smaller ids, distances from differences of the vectors."""
    q, x = _matrix(queries["q"]), _matrix(rows["v"])
    qid, xid = queries["query_id"].to_numpy(), rows["vec_id"].to_numpy()
    squares, made = (x**2).sum(1), []
    for at in range(0, len(q), BLOCK):
        block = q[at : at + BLOCK]
        norms = (block**2).sum(1)
        rough = squares + norms[:, None] - 2 * block @ x.T
        rough[qid[at : at + BLOCK, None] == xid] = np.inf
        keep = min(k, len(x))
        # The product form errs by a little; whoever is within that error of the k-th place is measured exactly.
        bound = np.partition(rough, keep - 1, axis=1)[:, keep - 1] + 1e-9 * (norms + squares.max())
        for i in range(len(block)):
            near = np.flatnonzero(rough[i] <= bound[i])
            near = near[np.isfinite(rough[i][near])]
            score = np.sqrt(((x[near] - block[i]) ** 2).sum(1))
            best = np.lexsort((xid[near], score))[:k]
            made.append((np.full(len(best), qid[at + i]), xid[near][best], score[best]))
    columns = [np.concatenate(c) for c in zip(*made)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))


def search(vectors: DataFrame, is_query: str, k: int = 10, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every row for which the condition on vec_id holds.

    Rows and queries are routed once and written with their parts; counts per part then say into how many cells of
    bounded size each side of a part is split.
    """
    rows = usable(vectors, id_col, vector_col)
    n = rows.count()
    index = build(rows, n)
    # Of rows that repeat a query id, the vector that is first in order asks.
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    placed = written(_routed(rows, index, 1), "ann-rows")
    probing = written(_routed(asked, index, index.probes if index else 1), "ann-queries")
    parts = index.parts if index else 1

    def cells(frame: DataFrame, size: int):
        count = {r[0]: r[1] for r in frame.groupBy("part").count().collect()}
        each = [max(1, math.ceil(count.get(p, 0) / size)) for p in range(parts)]
        return F.element_at(F.array(*(F.lit(e).cast("long") for e in each)), F.col("part") + 1)

    row_cells, query_cells = cells(placed, CELL_ROWS), cells(probing, CELL_QUERIES)
    own = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))
    left = placed.select(
        "part",
        (own % row_cells).alias("row_cell"),
        F.explode(F.sequence(F.lit(0).cast("long"), query_cells - 1)).alias("query_cell"),
        "vec_id",
        "v",
    )
    right = probing.select(
        "part",
        F.explode(F.sequence(F.lit(0).cast("long"), row_cells - 1)).alias("row_cell"),
        (own % query_cells).alias("query_cell"),
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("q"),
    )
    cell = ["part", "row_cell", "query_cell"]

    def compare(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        return _top(queries, candidates, k)

    near = (
        right.groupBy(*cell)
        .cogroup(left.groupBy(*cell))
        .applyInPandas(compare, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
