"""Token blocks: documents as packed integers, and counts of n-gram keys looked up for them.

A block holds the words of some documents once and the documents as indexes into them. Work on n-grams of a corpus is
two shuffles of packed arrays: every block sends its distinct n-grams with their counts to buckets by hash, and every
bucket answers each block with the totals. A very frequent n-gram is one entry per block like any other, so no key is
hot. N-grams are compared by 62 bits of a hash and their length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .common import from_planes, planes, sparing

# Tokens of a block, and of a bucket on average: two tasks of an executor hold one each.
BLOCK_TOKENS = 1 << 19
BUCKET_TOKENS = 1 << 19
END = b"\n"  # no word holds white space
START = np.uint64(0x9E3779B97F4A7C15)


def zipped(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(planes(values))


def unzipped(data: bytes, dtype) -> np.ndarray:
    return from_planes(zstandard.ZstdDecompressor().decompress(data), dtype)


def build(docs: DataFrame, id_col: str, text_col: str, kind: str) -> DataFrame:
    """(block, kind, ids, n_tokens, stops, words, tokens): the documents with null text as empty, ids as text.

    `kind` is an expression; a block holds documents of one kind. A-Z are lower-cased; each document's words are
    followed by an end token. Block numbers hold within one run, so the result is to be written before it is used.
    """
    source = docs.select(
        F.col(id_col).cast("string").alias("id"), F.expr(kind).cast("int").alias("kind"), F.col(text_col).alias("text")
    )
    schema = StructType(
        [
            StructField("block", LongType()),
            StructField("kind", IntegerType()),
            StructField("ids", ArrayType(StringType())),
            StructField("n_tokens", LongType()),
            StructField("stops", BinaryType()),
            StructField("words", BinaryType()),
            StructField("tokens", BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_blocks: dict[int, tuple] = {}

        def closed(kind: int) -> pa.RecordBatch:
            nonlocal number
            known, ids, parts, n = open_blocks.pop(kind)
            stops = np.cumsum([len(p) for p in parts])
            row = [
                number,
                kind,
                ids,
                n,
                zipped(stops.astype(np.uint32)),
                zstandard.ZstdCompressor(level=1).compress(b" ".join(known)),
                zipped(np.concatenate(parts)),
            ]
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow
            )

        for batch in batches:
            for name, kind, text in zip(*(c.to_pylist() for c in batch.columns)):
                known, ids, parts, n = open_blocks.get(kind) or ({END: 0}, [], [], 0)
                words = (text or "").encode().lower().split()
                words.append(END)
                parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint32, len(words)))
                ids.append(name)
                n += len(words)
                open_blocks[kind] = (known, ids, parts, n)
                if n >= BLOCK_TOKENS:
                    yield closed(kind)
        for kind in sorted(open_blocks):
            yield closed(kind)

    return source.mapInArrow(sparing(read), schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(before * np.uint64(0xD6E8FEB86659FD93) + after)


def word_hashes(blob: bytes) -> np.ndarray:
    words = zstandard.ZstdDecompressor().decompress(blob)
    # The end token, a line end, comes first; between the others stand blanks.
    rest = words[len(END) :].split()
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in (END, *rest)), np.uint64, len(rest) + 1)


def gram_keys(block, order: int) -> list[np.ndarray]:
    """For each length up to order the key of the n-gram that ends at each token; the low two bits say the length.

    What lies before a document's first word counts as a start token.
    """
    token = word_hashes(block.words)[unzipped(block.tokens, np.uint32)]
    stops = unzipped(block.stops, np.uint32)
    first = np.zeros(len(token), bool)
    first[0] = True
    first[stops[:-1]] = True
    low, keys, grams = np.uint64(3), [], token
    for n in range(order):
        if n:
            before = np.roll(grams, 1)
            before[first] = START + np.uint64(n)
            grams = chained(before, token)
        keys.append((grams & ~low) | np.uint64(n))
    return keys


def buckets_for(tokens: int, partitions: int) -> int:
    return max(4 * partitions, math.ceil(tokens / BUCKET_TOKENS))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket is a range of keys, so sorted keys fall into buckets in order."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def requests(blocks: DataFrame, keys_of, buckets: int) -> DataFrame:
    """(bucket, block, kind, keys, counts): the distinct n-grams of each block, packed by bucket.

    `keys_of` gives a block's keys, repeats included.
    """
    schema = "bucket long, block long, kind int, keys binary, counts binary"

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.itertuples(index=False):
                keys, counts = np.unique(keys_of(block), return_counts=True)
                bucket = bucket_of(keys, buckets)
                edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
                rows = [
                    (
                        bucket[a],
                        block.block,
                        block.kind,
                        planes(np.diff(keys[a:b], prepend=np.uint64(0))),
                        planes(counts[a:b].astype(np.uint32)),
                    )
                    for a, b in zip(edges, edges[1:])
                ]
                yield pd.DataFrame(rows, columns=["bucket", "block", "kind", "keys", "counts"])

    return blocks.select("block", "kind", "stops", "words", "tokens").mapInPandas(sparing(ask), schema)


def sent_keys(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)
