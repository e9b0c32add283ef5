"""Packing token sequences by minimum bin slack.

Documents become token pieces of at most a window. Only the histogram of piece lengths, which the window bounds,
reaches the driver. There the largest remaining length opens a window, a bitset subset-sum program over the remaining
multiset finds the filling closest to capacity, the counts are traced back, and the pattern is used as often as the
counts allow. Pieces then find their place by their rank among pieces of their length; ranks are summed over hashed
buckets, so a length that half of all pieces share is spread over many tasks.

Null or empty text is a document of the end token alone. A document longer than a window is cut into full windows and
a rest. Repeated rows are documents of their own. An empty table gives an empty result. Other columns stay out of the
result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import of_process, sparing, written

WINDOW = 2048
END_ID = 1

# Words that are turned into ids together, words remembered by a task (half of them stay when there are more), those that
# stay between tasks of a process, and words encoded as one text.
GROUP_WORDS, MEMO_WORDS, RESTING_WORDS, JOINED_WORDS = 100_000, 400_000, 100_000, 1000
# Documents of a batch that are texts in memory at a time.
ROWS_AT_ONCE = 500
STOPS = (b".", b",")


class _Numbers(dict):
    """Numbers new words as they are looked up."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class _Table:
    """Rows of ids of different lengths in one array."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids, lengths
        self.starts = np.cumsum(lengths) - lengths

    def rows(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows one after the other, and where each ends."""
        counts = self.lengths[index]
        upto = np.cumsum(counts)
        total = int(upto[-1]) if len(upto) else 0
        return self.ids[np.repeat(self.starts[index] - (upto - counts), counts) + np.arange(total)], upto

    def __add__(self, other: _Table) -> _Table:
        return _Table(np.concatenate([self.ids, other.ids]), np.concatenate([self.lengths, other.lengths]))


class Encoder:
    """Ids of texts, each distinct word encoded once.

    The tokenizer drops white space and never looks across it, so the ids of a text are those of its words one after
    the other. Only ASCII white space is split on here; any other is left to the tokenizer. Where it ignores the case
    of ASCII letters and splits off a full stop or comma behind them, such forms of a word are encoded once together.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.stops = self._encoded([b"", *STOPS])
        folded = self._encoded([b"Word.", b"WORD,", b"word", b"word"])
        parts = (self._encoded([b"word"]) + self.stops).rows(np.array([0, 2, 0, 3, 0, 0]))[0]
        self.folds = folded.ids.tolist() == parts.tolist()
        self.clear()

    def clear(self) -> None:
        self.known = _Numbers()
        # The row before all words is the end id.
        self.table = _Table(np.array([END_ID], np.uint32), np.array([1], np.int64))
        self.uses = np.zeros(1, np.int64)

    def rest(self) -> None:
        """Between tasks only the words that were used most are held."""
        if len(self.known) > RESTING_WORDS:
            self._cool(RESTING_WORDS)

    def _cool(self, left: int) -> None:
        """Forgets the words that were used least, later ones first among equals; the others count half from now on."""
        order = np.argsort(-self.uses[1:], kind="stable")[:left] + 1
        warm = np.sort(order)
        words = list(self.known)
        self.known = _Numbers()
        for k in (warm - 1).tolist():
            self.known[words[k]] = len(self.known)
        ids, upto = self.table.rows(np.append(0, warm))
        self.table = _Table(ids, np.diff(upto, prepend=0))
        self.uses = np.append(0, self.uses[warm] // 2)

    def _encoded(self, words: list[bytes]) -> _Table:
        """Ids of words, many joined by blanks in a text and told apart by the places of their tokens."""
        texts = [b" ".join(words[i : i + JOINED_WORDS]).decode() for i in range(0, len(words), JOINED_WORDS)]
        ids, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for text, found in zip(texts, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            blanks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == ord(" "))
            places = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
            lengths.append(np.bincount(np.searchsorted(blanks, places), minlength=len(blanks) + 1))
            ids.append(np.array(found.ids, np.uint32))
        return _Table(np.concatenate(ids), np.concatenate(lengths))

    def _learn(self) -> None:
        forms: dict[bytes, int] = {}
        places, stops = [], []
        for word in self.known.new:
            stop = 0
            if self.folds and word.isascii():
                core = word[:-1] if word[-1:] in STOPS else word
                if core.isalpha():
                    if core is not word:
                        stop = 1 + STOPS.index(word[-1:])
                    word = core.lower()
            places.append(forms.setdefault(word, len(forms)))
            stops.append(stop)
        index = np.array([places, stops], np.int64).T
        index[:, 1] += len(forms)
        made = self._encoded(list(forms)) + self.stops
        ids, upto = made.rows(index.reshape(-1))
        self.table += _Table(ids, np.diff(upto[1::2], prepend=0))
        self.known.new = []

    def group(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        """Ids of documents given as words, each followed by the end id."""
        number = self.known.__getitem__
        index = np.concatenate([np.fromiter((*map(number, w), -1), np.int64, len(w) + 1) for w in docs]) + 1
        if self.known.new:
            self._learn()
        ids, upto = self.table.rows(index)
        self.uses = np.bincount(index, minlength=len(self.table.lengths)) + np.pad(
            self.uses, (0, len(self.table.lengths) - len(self.uses))
        )
        if len(self.known) > MEMO_WORDS:
            self._cool(MEMO_WORDS // 2)
        return np.split(ids, upto[np.cumsum([len(w) + 1 for w in docs]) - 1][:-1])

    def texts(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in order, a bounded number of words at a time."""
        waiting, n = [], 0
        for text in texts:
            words = (text or "").encode().split()
            waiting.append(words)
            n += len(words)
            if n >= GROUP_WORDS:
                yield from self.group(waiting)
                waiting, n = [], 0
        if waiting:
            yield from self.group(waiting)


def pieces(
    docs: DataFrame, tokenizer: str, id_col="doc_id", text_col="text", window: int = WINDOW, with_ids=True
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, and the ids themselves if wanted.

    `tokenizer` is the path of a vocabulary file that every executor has.
    """
    source = docs.select(id_col, F.col(text_col).alias("__text"))
    fields = [source.schema[0]] + [
        StructField(c, LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")
    ]
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType())))
    schema = StructType(fields)
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = of_process(f"encoder {tokenizer}", lambda: Encoder(tokenizer))
        try:
            for batch in (b.slice(k, ROWS_AT_ONCE) for b in batches for k in range(0, b.num_rows, ROWS_AT_ONCE)):
                rows: list[list] = [[] for _ in fields]
                names = batch.column(0)
                origin = []
                for k, ids in enumerate(encoder.texts(batch.column(1).to_pylist())):
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        made = (start, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), len(ids), piece)
                        origin.append(k)
                        for column, value in zip(rows[1:], made):
                            column.append(value)
                columns = [names.take(pa.array(origin, pa.int64())).cast(arrow.field(0).type)]
                columns += [pa.array(v, f.type) for v, f in zip(rows[1:], list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        finally:
            encoder.rest()

    return source.mapInArrow(sparing(cut), schema)


def fill(rest: int, counts: list[tuple[int, int]]) -> dict[int, int]:
    """The multiset of lengths, out of (length, count), whose total comes closest to rest without passing it."""
    reach, mask, steps = 1, (1 << (rest + 1)) - 1, []
    for length, count in counts:
        if length > rest:
            continue
        steps.append((length, reach))
        left, batch = min(count, rest // length), 1
        while left:
            batch = min(batch, left)
            reach |= (reach << (batch * length)) & mask
            left, batch = left - batch, batch * 2
        if reach >> rest & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> total & 1:
            total -= length
            used[length] = used.get(length, 0) + 1
    return used


def patterns(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, dict[int, int]]]:
    """(how often, lengths in one window) until no piece is left; the number depends on the window, not the data."""
    left, found = dict(sorted(histogram.items(), reverse=True)), []
    while left:
        largest = next(iter(left))
        left[largest] -= 1
        used = fill(window - largest, [(n, c) for n, c in left.items() if c])
        left[largest] += 1
        used[largest] = used.get(largest, 0) + 1
        times = min(left[n] // c for n, c in used.items())
        for n, c in used.items():
            left[n] -= times * c
            if not left[n]:
                del left[n]
        found.append((times, dict(sorted(used.items(), reverse=True))))
    return found


def plan(histogram: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Rows (length, first rank, pieces a window, first sequence, offset), sorted: where each rank of a length goes."""
    rows, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for times, used in patterns(histogram, window):
        offset = 0
        for length, count in used.items():
            rows.append((length, taken[length], count, sequence, offset))
            taken[length] += times * count
            offset += length * count
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(made: DataFrame, id_col="doc_id", window: int = WINDOW) -> DataFrame:
    """The pieces with sequence_id and offset. The given table is read three times and should be a written one."""
    histogram = {r[0]: r[1] for r in made.groupBy("length").count().collect()}
    spread = max(64, sum(histogram.values()) // 20_000)
    steps = plan(histogram, window)
    keyed = made.withColumn("__bucket", F.expr(f"pmod(xxhash64({id_col}, start), {spread})"))
    counted = keyed.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counted.select(
        "length",
        "__bucket",
        (F.sum("n").over(Window.partitionBy("length").orderBy("__bucket")) - F.col("n")).alias("__before"),
    )
    order = Window.partitionBy("length", "__bucket").orderBy(id_col, "start", "ids_crc32", "doc_tokens")
    ranked = (
        keyed.join(before, ["length", "__bucket"])
        .withColumn("__rank", F.row_number().over(order) - 1 + F.col("__before"))
        .select(*made.columns, "__rank")
    )
    schema = StructType(made.schema.fields + [StructField(c, LongType()) for c in ("sequence_id", "offset")])
    arrow, length_at = to_arrow_schema(schema), made.columns.index("length")
    codes = (steps[:, 0] << 44) + steps[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(length_at).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            step = steps[np.searchsorted(codes, (length << 44) + rank, "right") - 1]
            past, within = np.divmod(rank - step[:, 1], step[:, 2])
            placed = [pa.array(step[:, 3] + past), pa.array(step[:, 4] + within * length)]
            columns = [c.cast(arrow.field(i).type) for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns + placed, schema=arrow)

    return ranked.mapInArrow(sparing(place), schema)


def sequences(packed: DataFrame, id_col="doc_id", window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, input_ids, pieces) from packed pieces with ids; a sequence's rows are bounded by the window.

    A sequence is padded to the window, except where its length is a power of two.
    """
    held = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", F.col(id_col).alias("id"), "start", "length", "ids"))).alias("p")
    )
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    full = held.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: x.dropFields("ids")).alias("pieces"))
    n = F.size("ids")
    padding = F.when(F.bit_count(n) == 1, 0).otherwise(window - n)
    return full.select(
        "sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), padding)).alias("input_ids"), "pieces"
    )


def packed_documents(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Pieces written once and packed."""
    return pack(written(pieces(docs, tokenizer, with_ids=with_ids), "packing-pieces"))
