"""Language-model scores by deleted interpolation.

N-gram counts of all training documents give maximum-likelihood estimates for each n-gram length. A token's probability
mixes them and the uniform distribution; the weights depend on how often the token's context was seen, in buckets that
double. They are learned by expectation-maximisation on one tenth of the training documents, whose own counts are taken
out of the estimates for that (the deleted part); the final estimates are those of all training documents.

Counts, vocabulary and held-out events cover the whole corpus and are shuffled as packed blocks. Only the table of
held-out events by (context bucket, estimates to a quarter octave) reaches the driver; its size is bounded by the grid.

Null or empty text is the end token alone. A null id is folded as empty text. Repeated rows are documents of their own.
An empty table gives an empty result. Without training tokens all weight is uniform. Other columns stay out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from . import blocks as bk
from .common import from_planes, written

# Folds, the smoothing of the base score.
FOLDS = 10
ADDED = 0.1
# The order and the sweeps of the estimation.
ORDER, SWEEPS = 2, 60
GRID = 4
NEVER = -(1 << 15)
LEAST_WEIGHT = 1e-6

SCORED, DELETED, TRAINED = 0, 1, 2


def fold_kind(id_col: str) -> str:
    fold = f"crc32(cast(coalesce(cast({id_col} as string), '') as binary)) % {FOLDS}"
    return f"least({fold}, {TRAINED})"


def _answers(asked: DataFrame) -> DataFrame:
    """(block, kind, bucket, trained, deleted, vocabulary): for each key sent, its counts over the training blocks.

    `deleted` are the counts of the deleted part, sent to that part's blocks only. `vocabulary` stands once per bucket.
    """

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [bk.sent_keys(k) for k in rows["keys"]]
        counts = [from_planes(c, np.uint32).astype(np.int64) for c in rows["counts"]]
        kinds = np.repeat(rows["kind"].to_numpy(), [len(k) for k in keys])
        known, place = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.concatenate(counts)
        deleted = np.bincount(place, n * (kinds == DELETED), minlength=len(known)).astype(np.uint64)
        trained = np.bincount(place, n * (kinds != SCORED), minlength=len(known)).astype(np.uint64)
        words = int(((known & np.uint64(3) == 0) & (trained > 0)).sum())
        made, at = [], 0
        for k, (block, kind, bucket) in enumerate(zip(rows["block"], rows["kind"], rows["bucket"])):
            here = place[at : at + len(keys[k])]
            at += len(keys[k])
            taken = bk.zipped(deleted[here]) if kind == DELETED else None
            made.append((block, kind, bucket, bk.zipped(trained[here]), taken, 0 if k else words))
        return pd.DataFrame(made, columns=["block", "kind", "bucket", "trained", "deleted", "vocabulary"])

    schema = "block long, kind int, bucket long, trained binary, deleted binary, vocabulary long"
    return asked.groupBy("bucket").applyInPandas(total, schema)


def _token_counts(block, answers: pd.DataFrame, order: int, column: str) -> list[np.ndarray]:
    """For each n-gram length the counts at each token."""
    keys = bk.gram_keys(block, order)
    place = np.unique(np.concatenate(keys), return_inverse=True)[1]
    ordered = answers.sort_values("bucket")[column]
    counts = np.concatenate([bk.unzipped(c, np.uint64) for c in ordered])[place].astype(np.int64)
    return np.split(counts, order)


def _estimates(counts: list[np.ndarray], stops: np.ndarray, docs: int, tokens: int):
    """Maximum-likelihood estimates by length, and the count of the longest context."""
    first = np.zeros(len(counts[0]), bool)
    first[0] = True
    first[stops[:-1]] = True
    found, context = [counts[0] / max(tokens, 1)], np.full(len(counts[0]), tokens)
    for shorter, count in zip(counts, counts[1:]):
        context = np.roll(shorter, 1)
        context[first] = docs
        found.append(np.divide(count, context, out=np.zeros(len(count)), where=context > 0))
    return found, context


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else the number of bits of its count."""
    return np.frexp(np.maximum(context, 0).astype(np.float64))[1]


def _cells(values: np.ndarray) -> np.ndarray:
    seen = values > 0
    return np.where(seen, np.rint(GRID * np.log2(np.where(seen, values, 1))), NEVER).astype(np.int64)


def learned_weights(events: pd.DataFrame, order: int, uniform: float) -> np.ndarray:
    """Weights by context bucket, uniform first; events has columns bucket, e1.., n.

    Buckets without events take the weights of all events together.
    """

    def em(part: pd.DataFrame) -> np.ndarray:
        estimates = np.full((len(part), order + 1), uniform)
        for k in range(1, order + 1):
            cell = part[f"e{k}"].to_numpy()
            estimates[:, k] = np.where(cell == NEVER, 0.0, 2.0 ** (np.where(cell == NEVER, 0, cell) / GRID))
        n, weights = part["n"].to_numpy().astype(float), np.full(order + 1, 1 / (order + 1))
        for _ in range(SWEEPS):
            share = estimates * weights
            weights = (n[:, None] * share / share.sum(1, keepdims=True)).sum(0) / n.sum()
        weights = np.maximum(weights, LEAST_WEIGHT)
        return weights / weights.sum()

    if not len(events):
        return np.tile(np.full(order + 1, 1 / (order + 1)), (65, 1))
    events = events.sort_values(list(events.columns))
    weights = np.tile(em(events), (65, 1))
    for bucket, part in events.groupby("bucket"):
        weights[bucket] = em(part)
    return weights


def score(docs: DataFrame, id_col="doc_id", text_col="text", order: int = ORDER) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    blocks = written(bk.build(docs, id_col, text_col, fold_kind(id_col)), "lm-blocks")
    sizes = {
        r["kind"]: r
        for r in blocks.groupBy("kind").agg(F.sum("n_tokens").alias("tokens"), F.sum(F.size("ids")).alias("docs")).collect()
    }

    def size(column, *kinds):
        return sum(sizes[k][column] for k in kinds if k in sizes)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = bk.buckets_for(size("tokens", SCORED, DELETED, TRAINED), partitions)
    answers = written(_answers(bk.requests(blocks, lambda block: np.concatenate(bk.gram_keys(block, order)), buckets)), "lm-counts")
    vocabulary = answers.agg(F.sum("vocabulary")).first()[0] or 0
    uniform = 1 / (vocabulary + 1)
    rest = size("docs", TRAINED), size("tokens", TRAINED)
    every = size("docs", DELETED, TRAINED), size("tokens", DELETED, TRAINED)
    cells = ["bucket", *(f"e{k}" for k in range(1, order + 1))]

    def held_out_events(block_rows: pd.DataFrame, answer_rows: pd.DataFrame) -> pd.DataFrame:
        block = next(block_rows.itertuples(index=False))
        trained = _token_counts(block, answer_rows, order, "trained")
        deleted = _token_counts(block, answer_rows, order, "deleted")
        left = [a - b for a, b in zip(trained, deleted)]
        estimates, context = _estimates(left, bk.unzipped(block.stops, np.uint32), *rest)
        table = np.stack([_bucket(context), *map(_cells, estimates)], axis=1)
        found, n = np.unique(table, axis=0, return_counts=True)
        return pd.DataFrame(found, columns=cells).assign(n=n)

    events = (
        blocks.filter(F.col("kind") == DELETED)
        .groupBy("block")
        .cogroup(answers.filter(F.col("kind") == DELETED).groupBy("block"))
        .applyInPandas(held_out_events, ", ".join(f"{c} long" for c in [*cells, "n"]))
        .groupBy(*cells)
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    weights = learned_weights(events, order, uniform)
    docs_in, tokens_in = every
    if not tokens_in:
        weights[:] = np.eye(order + 1)[0]

    def scored(block_rows: pd.DataFrame, answer_rows: pd.DataFrame) -> pd.DataFrame:
        block = next(block_rows.itertuples(index=False))
        counts = _token_counts(block, answer_rows, order, "trained")
        stops = bk.unzipped(block.stops, np.uint32).astype(np.int64)
        starts = np.concatenate([[0], stops[:-1]])
        estimates, context = _estimates(counts, stops, docs_in, tokens_in)
        weight = weights[_bucket(context)]
        chance = weight[:, 0] * uniform + sum(weight[:, k + 1] * e for k, e in enumerate(estimates))
        plain = (counts[0] + ADDED) / (tokens_in + ADDED * (vocabulary + 1))
        return pd.DataFrame(
            {
                "id": list(block.ids),
                "held_out": block.kind == SCORED,
                "n_tokens": stops - starts,
                "n_known": np.add.reduceat(counts[0] > 0, starts, dtype=np.int64),
                "train_tokens": tokens_in,
                "base_score": np.add.reduceat(np.log10(plain), starts),
                "score": np.add.reduceat(np.log10(chance), starts),
            }
        )

    longs, doubles = ("n_tokens", "n_known", "train_tokens"), ("base_score", "score")
    schema = StructType(
        [StructField("id", StringType()), StructField("held_out", BooleanType())]
        + [StructField(c, LongType()) for c in longs]
        + [StructField(c, DoubleType()) for c in doubles]
    )
    return (
        blocks.groupBy("block")
        .cogroup(answers.select("block", "bucket", "trained").groupBy("block"))
        .applyInPandas(scored, schema)
        .select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *schema.fieldNames()[1:])
    )
