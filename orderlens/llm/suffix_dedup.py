"""Repeated byte strings by distributed prefix doubling.

A byte goes if a string of `length` bytes that covers it starts anywhere else as well, in the same document or in
another one; overlaps count, and strings are judged on the input. Matches never cross documents.

1. **Positions.** Not every byte is a position. A start's anchor is the least hashed 8-byte word in the window behind it
   (the leftmost of equals), so equal strings of `length` bytes have the same anchors at the same places. Anchors cut a
   document into phrases of about half a window; a phrase's first name is a hash of 96 bits of its bytes.
2. **Doubling.** A position's rank stands for the run of phrases from it on that has been compared. In every round the pairs
   (rank of the run, rank of the run behind it) are sorted and ranked anew: a pair that is unique ends its position, a run
   past `length` bytes is repeated text and rests with its rank, all others go on with runs of double length. Pairs are sorted
   within buckets of a mix of both ranks, as only equality is asked for; so pairs that share a very frequent rank are spread.
3. **Ends.** Bytes outside whole phrases remain at the two ends of a match. Strings that hold such a byte and whose
   phrases are all repeated, as far as the ranks tell, are compared as a whole by a hash of 96 bits, together with all
   strings that could equal them: those around the same bytes behind their anchor.

Positions live in blocks of about two million bytes. A block sends its distinct keys to buckets, a bucket answers each block:
packed arrays, a very frequent key is one entry per block, and neither blocks nor buckets grow with the corpus. Only the
number of open positions reaches the driver, once a round; the rounds are about log2 of `length` over the mean phrase.

Null or empty text has no bytes, and a text shorter than `length` stays whole. Repeated rows are copies of each other, a
null or repeated id is an id like any other. An empty table gives an empty result. Other columns stay out of the result.
A long document is one block; its arrays take some 40 bytes a byte in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .blocks import bucket_of, mixed, unzipped, zipped
from .common import written

LENGTH = 400
# Starts that share an anchor at most, bytes of a hashed word.
WINDOW, WORD = 96, 8
SHORTEST = 32
# Bytes of a block, and keys of a bucket on average.
BLOCK_BYTES = 1 << 21
BUCKET_KEYS = 1 << 18
# Bytes hashed at once, inside a block.
SLICE = 1 << 20
NO_START = np.uint32(0xFFFFFFFF)

Keys = tuple[np.ndarray, np.ndarray, np.ndarray]


def window_for(length: int) -> int:
    if length < SHORTEST:
        raise ValueError(f"strings of {SHORTEST} bytes at least")
    return min(WINDOW, (length - WORD) // 4)


def _gaps(values: np.ndarray) -> bytes:
    return zipped(np.diff(values, prepend=0).astype(np.uint64))


def _from_gaps(data: bytes) -> np.ndarray:
    return np.cumsum(unzipped(data, np.uint64)).astype(np.int64)


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of the ranges first..last, and which range each is of; a range may be empty."""
    n = np.maximum(last - first + 1, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[owner], owner


def nearest_words(data: np.ndarray, window: int) -> np.ndarray:
    """For every start whose window lies in the data the place of its least hashed word, the leftmost of equals."""
    starts = len(data) - window - WORD + 2
    found = [np.zeros(0, np.int64)]
    for a in range(0, max(starts, 0), SLICE):
        part = np.ascontiguousarray(data[a : min(a + SLICE, starts) + window + WORD - 2])
        words = np.ndarray((len(part) - WORD + 1,), "<u8", part, strides=(1,))
        least = (mixed(words.copy()) & ~np.uint64(0xFFFFFFFF)) | np.arange(len(words), dtype=np.uint64)
        reach = 1
        while reach * 2 <= window:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < window:
            least = np.minimum(least[: len(words) - window + 1], least[window - reach :])
        found.append((least & np.uint64(0xFFFFFFFF)).astype(np.int64) + a)
    return np.concatenate(found)


def phrases(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrases of each document, where each starts, how far before it the first start with that anchor lies).

    A document's first phrase starts with it; where no anchor stands there, no start has it (`NO_START`).
    """
    window = window_for(length)
    ends = np.cumsum(sizes)
    long = np.flatnonzero(sizes >= length)
    starts, owner = _ranges((ends - sizes)[long], ends[long] - window - WORD + 1)
    anchors = nearest_words(data, window)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
    at, before, owner = anchors[new], (anchors - starts)[new].astype(np.uint32), long[owner[new]]
    heads = (ends - sizes)[long]
    bare = ~np.isin(heads, at)
    at = np.concatenate([at, heads[bare]])
    order = np.argsort(at, kind="stable")
    before = np.concatenate([before, np.full(bare.sum(), NO_START)])[order]
    owner = np.concatenate([owner, long[bare]])[order]
    return np.bincount(owner, minlength=len(sizes)), at[order], before


class _Places:
    """A block's phrases: where each starts and ends, and the document it belongs to."""

    def __init__(self, row):
        self.sizes = unzipped(row.sizes, np.uint64).astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.counts = unzipped(row.phrases, np.uint32).astype(np.int64)
        self.at = _from_gaps(row.starts)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.stop = np.cumsum(self.counts)[self.doc]
        self.doc_end = self.ends[self.doc]

    def edge(self, index: np.ndarray) -> np.ndarray:
        """The byte where a run ends that goes up to the given phrase of the same document."""
        inside = self.at[np.minimum(index, len(self.at) - 1)] if len(self.at) else index
        return np.where(index < self.stop, inside, self.doc_end)


def _names(parts: Iterator[memoryview]) -> tuple[np.ndarray, np.ndarray]:
    # A list of all parts would cost more than their hashes.
    digest = xxhash.xxh3_128_digest
    both = np.frombuffer(b"".join(map(digest, parts)), ">u8").astype(np.uint64).reshape(-1, 2)
    return both[:, 0], (both[:, 1] >> np.uint64(32)).astype(np.uint32)


def _text(row) -> bytes:
    return zstandard.ZstdDecompressor().decompress(row.text)


def build(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(block, ids, sizes, text, n, phrases, starts, before, cores, high, low): documents and their phrases.

    Block numbers hold within one run, so the result is to be written before it is used.
    """
    source = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    binary = ("sizes", "text", "phrases", "starts", "before", "cores", "high", "low")
    schema = StructType(
        [StructField("block", LongType()), StructField("ids", ArrayType(StringType())), StructField("n", LongType())]
        + [StructField(c, BinaryType()) for c in binary]
    )
    arrow = to_arrow_schema(schema)
    core = length - window_for(length) + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, total = [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal number, ids, texts, total
            blob, sizes = b"".join(texts), np.array([len(t) for t in texts], np.int64)
            data, view = np.frombuffer(blob, np.uint8), memoryview(blob)
            counts, at, before = phrases(data, sizes, length)
            ends = np.cumsum(sizes)
            doc_end = np.repeat(ends, counts)
            upto = np.append(at[1:], 0)
            upto = np.where(np.arange(len(at)) + 1 < np.repeat(np.cumsum(counts), counts), upto, doc_end)
            high, low = _names(view[a:b] for a, b in zip(at.tolist(), upto.tolist()))
            cores = np.fromiter((xxhash.xxh3_64_intdigest(view[a : a + core]) for a in at.tolist()), np.uint64, len(at))
            made = [
                zipped(sizes.astype(np.uint64)),
                zstandard.ZstdCompressor(level=1).compress(blob),
                zipped(counts.astype(np.uint32)),
                _gaps(at),
                zipped(before),
                zipped(cores),
                zipped(high),
                zipped(low),
            ]
            row = [number, ids, len(at), *made]
            number, ids, texts, total = number + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(name)
                texts.append((text or "").encode())
                total += len(texts[-1])
                if total >= BLOCK_BYTES:
                    yield closed()
        if ids:
            yield closed()

    return source.mapInArrow(read, schema)


# Keys sent to buckets, and their answers


def _distinct(keys: Keys):
    """The different keys in order, whether each stands twice or is marked, and which of them each given key is."""
    high, low, marks = keys
    # One plain sort is some eight times as fast as one by both parts, and settles all but clashes of the first part.
    order = np.argsort(high)
    highs, lows = high[order], low[order]
    other = highs[1:] != highs[:-1]
    if np.any(~other & (lows[1:] != lows[:-1])):
        order = np.lexsort((low, high))
        highs, lows = high[order], low[order]
        other = (highs[1:] != highs[:-1]) | (lows[1:] != lows[:-1])
    new = np.ones(len(order), bool)
    new[1:] = other
    first = np.flatnonzero(new)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    n = np.diff(np.append(first, len(order)))
    marked = np.logical_or.reduceat(marks[order], first) if len(first) else np.zeros(0, bool)
    return highs[first], lows[first], n, marked, place


def _asked(rows: DataFrame, keys_of: Callable[..., Keys], buckets: int) -> DataFrame:
    """(bucket, block, high, low, state): the distinct keys of each block; state has 1 for a repeat, 2 for a mark."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                high, low, n, marked, _ = _distinct(keys_of(row))
                state = ((n > 1) + 2 * marked).astype(np.uint8)
                bucket = bucket_of(high, buckets)
                edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
                sent = [
                    (bucket[a], row.block, zipped(high[a:b]), zipped(low[a:b]), zipped(state[a:b]))
                    for a, b in zip(edges, edges[1:])
                ]
                yield pd.DataFrame(sent, columns=["bucket", "block", "high", "low", "state"])

    return rows.mapInPandas(ask, "bucket long, block long, high binary, low binary, state binary")


def _answers(asked: DataFrame, turn: int, marked_only: bool = False, low_type=np.uint32) -> DataFrame:
    """(block, bucket, ranks): for each key sent 0 if it stands once in all, else its rank, the same for equal keys.

    With `marked_only` a key that no block marked gets 0 as well. Ranks of different turns differ.
    """

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        sent = [unzipped(s, np.uint8) for s in rows["state"]]
        state = np.concatenate(sent)
        high = np.concatenate([unzipped(v, np.uint64) for v in rows["high"]])
        low = np.concatenate([unzipped(v, low_type) for v in rows["low"]])
        _, _, n, marked, place = _distinct((high, low, state >= 2))
        again = n > 1
        again[place[state % 2 == 1]] = True
        if marked_only:
            again &= marked
        base = (turn << 56) + (int(rows["bucket"].iloc[0]) << 28) + 1
        ranks = np.where(again, np.arange(len(n), dtype=np.uint64) + np.uint64(base), np.uint64(0))[place]
        found = [zipped(r) for r in np.split(ranks, np.cumsum([len(s) for s in sent])[:-1])]
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "ranks": found})

    return asked.groupBy("bucket").applyInPandas(sort, "block long, bucket long, ranks binary")


def _told(keys: Keys, answers: pd.DataFrame) -> np.ndarray:
    """The rank of each key, from the answers to its block."""
    if not len(answers):
        return np.zeros(len(keys[0]), np.uint64)
    ranks = np.concatenate([unzipped(r, np.uint64) for r in answers.sort_values("bucket")["ranks"]])
    return ranks[_distinct(keys)[-1]]


# Doubling


_STATE = "block long, going long, ranks binary, runs binary"


def _state_row(row, places: _Places, ranks: np.ndarray, upto: np.ndarray, length: int) -> pd.DataFrame:
    """The block's next state. Ranks stay where a run that is still compared can reach them."""
    going = (ranks > 0) & (places.edge(upto) - places.at < length)
    last = np.maximum.accumulate(np.where(going, places.at, -length)) if len(going) else places.at
    ranks = np.where(places.at - last < length, ranks, np.uint64(0))
    runs = (upto - np.arange(len(upto))).astype(np.uint32)
    made = (row.block, int(going.sum()), zipped(ranks), zipped(runs))
    return pd.DataFrame([made], columns=["block", "going", "ranks", "runs"])


def _first_keys(row) -> Keys:
    high = unzipped(row.high, np.uint64)
    return high, unzipped(row.low, np.uint32), np.zeros(len(high), bool)


def _first_ranks(length: int):
    def rank(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = next(rows.itertuples(index=False))
        places, ranks = _Places(row), _told(_first_keys(row), answers)
        return _state_row(row, places, ranks, np.arange(len(ranks)) + (ranks > 0), length)

    return rank


def _open(row, length: int):
    """A block's places, ranks and runs, the positions that are still compared, and those with a run behind theirs."""
    places, ranks = _Places(row), unzipped(row.ranks, np.uint64)
    upto = np.arange(len(ranks)) + unzipped(row.runs, np.uint32)
    going = np.flatnonzero((ranks > 0) & (places.edge(upto) - places.at < length))
    behind = upto[going]
    paired = behind < places.stop[going]
    paired[paired] = ranks[behind[paired]] > 0
    return places, ranks, upto, going, going[paired]


def _pair_keys(ranks: np.ndarray, upto: np.ndarray, asking: np.ndarray) -> Keys:
    """One key for each pair of ranks, and no other: the first is mixed with the second, which stands beside it."""
    behind = ranks[upto[asking]]
    return mixed(ranks[asking] ^ mixed(behind)), behind, np.zeros(len(asking), bool)


def _pair_request(length: int):
    def keys(row) -> Keys:
        _, ranks, upto, _, asking = _open(row, length)
        return _pair_keys(ranks, upto, asking)

    return keys


def _next_ranks(length: int):
    def rank(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = next(rows.itertuples(index=False))
        places, ranks, upto, going, asking = _open(row, length)
        new = _told(_pair_keys(ranks, upto, asking), answers)
        longer = upto[upto[asking]]
        ranks, upto = ranks.copy(), upto.copy()
        ranks[going] = 0
        ranks[asking] = new
        upto[asking[new > 0]] = longer[new > 0]
        return _state_row(row, places, ranks, upto, length)

    return rank


def doubled(blocks: DataFrame, length: int, buckets: int) -> DataFrame:
    """For every phrase the longest repeated run from it that the doubling met: (block, runs)."""
    places = blocks.select("block", "sizes", "phrases", "starts")
    rows, turn = blocks.select("block", "sizes", "phrases", "starts", "high", "low"), 0
    asked, low_type, step = _asked(rows.select("block", "high", "low"), _first_keys, buckets), np.uint32, _first_ranks
    while True:
        answers = written(_answers(asked, turn, low_type=low_type), f"suffix-ranks-{turn}")
        made = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(step(length), _STATE)
        state = written(made, f"suffix-runs-{turn}")
        if not state.agg(F.sum("going")).first()[0]:
            return state.select("block", "runs")
        rows, turn = places.join(state.drop("going"), "block"), turn + 1
        asked, low_type, step = _asked(rows, _pair_request(length), buckets), np.uint64, _next_ranks


# Ends of matches


def _spread(total: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of the bytes lie in one of the ranges first..last (end exclusive)."""
    depth = np.zeros(total + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, last, -1)
    return np.cumsum(depth[:-1]) > 0


def _past(row, places: _Places, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases a run has, and whether it is past the length."""
    runs = unzipped(row.runs, np.uint32).astype(np.int64)
    ends = places.edge(np.arange(len(runs)) + runs)
    return runs, (runs > 0) & (ends - places.at >= length)


def _covered(row, places: _Places, length: int) -> np.ndarray:
    """Which bytes lie in a run past the length."""
    runs, past = _past(row, places, length)
    ends = places.edge(np.arange(len(runs)) + runs)
    return _spread(int(places.ends[-1]) if len(places.ends) else 0, places.at[past], ends[past])


def _strings(row, length: int):
    """(start, phrase of its anchor, whether it holds an uncovered byte) of the strings that may be repeated.

    If a string is repeated, so is the run of phrases between its first and its last anchor; doubling then met two runs of
    the largest power of two, one from the first anchor and one up to the last, or runs past the length.
    """
    window, places = window_for(length), _Places(row)
    before = unzipped(row.before, np.uint32)
    runs, past = _past(row, places, length)
    real = np.flatnonzero(before != NO_START)
    low = places.at[real] - before[real]
    last = np.append(low[1:], 0) - 1
    final = np.append(places.doc[real][1:] != places.doc[real][:-1], True) if len(real) else np.zeros(0, bool)
    last = np.minimum(np.where(final, places.doc_end[real], last), places.doc_end[real] - length)
    some = np.flatnonzero(runs[real] > 0)
    starts, owner = _ranges(low[some], last[some])
    first = real[some][owner]
    end = real[np.searchsorted(low, starts + length - window - WORD + 1, "right") - 1] if len(starts) else first
    span = end - first
    power = np.left_shift(1, np.maximum(np.frexp(np.maximum(span, 1).astype(float))[1] - 1, 0))
    second = np.maximum(end - power, 0)
    may = (span > 0) & ((runs[first] >= power) | past[first]) & ((runs[second] >= power) | past[second])
    starts, first = starts[may], first[may]
    dark = np.concatenate([[0], np.cumsum(_covered(row, places, length))])
    return starts, first, dark[starts + length] - dark[starts] < length


def _core_keys(row, length: int) -> tuple[Keys, np.ndarray, np.ndarray]:
    starts, first, asking = _strings(row, length)
    anchors, place = np.unique(first, return_inverse=True)
    marks = np.bincount(place, asking, minlength=len(anchors)) > 0
    return (unzipped(row.cores, np.uint64)[anchors], np.zeros(len(anchors), np.uint32), marks), starts, place


def _core_request(length: int):
    return lambda row: _core_keys(row, length)[0]


def _to_compare(length: int):
    """The strings around cores that a string with an uncovered byte shares with another place."""

    def choose(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = next(rows.itertuples(index=False))
        keys, starts, place = _core_keys(row, length)
        wanted = _told(keys, answers) > 0
        covered = _covered(row, _Places(row), length)
        flips = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
        made = (row.block, _gaps(flips), _gaps(starts[wanted[place]]))
        return pd.DataFrame([made], columns=["block", "flips", "strings"])

    return choose


def _string_keys(row, data: bytes, length: int) -> Keys:
    view = memoryview(data)
    high, low = _names(view[s : s + length] for s in _from_gaps(row.strings).tolist())
    return high, low, np.zeros(len(high), bool)


def _string_request(length: int):
    return lambda row: _string_keys(row, _text(row), length)


def _result(length: int):
    def cut(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = next(rows.itertuples(index=False))
        blob = _text(row)
        data, strings, flips = np.frombuffer(blob, np.uint8), _from_gaps(row.strings), _from_gaps(row.flips)
        again = strings[_told(_string_keys(row, blob, length), answers) > 0]
        first, last = np.concatenate([flips[::2], again]), np.concatenate([flips[1::2], again + length])
        gone = _spread(len(data), first, last)
        sizes = unzipped(row.sizes, np.uint64).astype(np.int64)
        made, end = [], 0
        for name, size in zip(row.ids, sizes.tolist()):
            start, end = end, end + size
            own = gone[start:end]
            edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
            made.append((name, size, edges[::2], edges[1::2], data[start:end][~own].tobytes()))
        return pd.DataFrame(made, columns=["id", "n_bytes", "starts", "ends", "kept"])

    return cut


def without_repeats(docs: DataFrame, id_col="doc_id", text_col="text", length: int = LENGTH) -> DataFrame:
    """id, n_bytes, spans (start, end in UTF-8 bytes, end exclusive) that are removed, kept (the other bytes)."""
    blocks = written(build(docs, id_col, text_col, length), "suffix-blocks")
    n = blocks.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / BUCKET_KEYS))
    runs = doubled(blocks, length, buckets)

    placed = runs.join(blocks.select("block", "sizes", "phrases", "starts", "before", "cores"), "block")
    asked = _answers(_asked(placed, _core_request(length), buckets), 0, marked_only=True)
    chosen = placed.groupBy("block").cogroup(asked.groupBy("block"))
    strings = written(chosen.applyInPandas(_to_compare(length), "block long, flips binary, strings binary"), "suffix-strings")

    texts = blocks.select("block", "ids", "sizes", "text").join(strings, "block")
    answers = written(_answers(_asked(texts.drop("ids"), _string_request(length), buckets), 0), "suffix-equal")
    made = texts.groupBy("block").cogroup(answers.groupBy("block"))
    rows = made.applyInPandas(_result(length), "id string, n_bytes long, starts array<long>, ends array<long>, kept binary")
    return rows.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        "n_bytes",
        F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")).alias("spans"),
        "kept",
    )


def digest(found: DataFrame, id_col="doc_id") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256."""
    return found.select(
        id_col,
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
