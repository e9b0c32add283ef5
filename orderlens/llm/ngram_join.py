"""Near-duplicate documents: a Jaccard self-join of word shingles by rare-first prefixes.

Shingle frequencies over all documents order every document's shingles, rarest first. Two sets that are similar enough
share a shingle within both prefixes, so sets meet on prefix shingles only, and only on such as occur twice at all; a
document in which too few shingles do is alone without any comparison. Length, position and suffix filters bound the
overlap of a meeting, and what passes is verified once per pair on the whole sets.

A shingle shared by k sets is not expanded into k(k-1)/2 pairs. The sets of a shingle first meet its central set.
Then only sets that are not yet connected meet: those outside the shingle's largest component meet all others. The
result, the connected components, is the same as with all pairs.

Texts are lower-cased in A-Z and split into words; a document with fewer words than a shingle has is one shingle; one
without words or with null text has none and is linked with nothing. Equal sets are one set throughout, named by a
128-bit digest. Documents with a null id are linked with nothing and have a null component; rows that repeat an id are
judged by their own texts. An empty table gives an empty result. Other columns stay out. Sets are compared by 64-bit
hashes of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType, StructType

from . import blocks as bk
from .common import from_planes, sparing, sparing_group, sparing_pair, written
from .components import components

SHINGLE = 5
# Similarity 4/5: sets x and y are linked if 5 * overlap >= 4 * union.
NUMERATOR, DENOMINATOR = 4, 5
SUFFIX_PARTS, MOST = 32, 30_000
SETS_AT_ONCE = 200
_ENTRY = "key long, rep binary, n long, r long, pos long, suffix array<short>"
# Frequencies are counted by the high bits of a shingle's hash. A collision makes a shingle look more frequent, which
# costs a comparison and no result.
FREQUENCY_BITS = np.uint64(16)


def document_sets(block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, key) of the distinct shingles, sorted by both, and the number of shingles of each document."""
    hashes = bk.word_hashes(block.words)[bk.unzipped(block.tokens, np.uint32)]
    stops = bk.unzipped(block.stops, np.uint32).astype(np.int64)
    ends, starts = stops - 1, np.concatenate([[0], stops[:-1]])
    words = ends - starts
    chains = hashes
    for _ in range(size - 1):
        after = np.roll(hashes, -1)
        chains, hashes = bk.chained(chains, after), after
    documents = np.repeat(np.arange(len(stops)), stops - starts)
    inside = np.arange(len(documents)) <= (ends - size)[documents]
    keys, owners = chains[inside], documents[inside]
    hashes = bk.word_hashes(block.words)[bk.unzipped(block.tokens, np.uint32)]
    short = np.flatnonzero((words > 0) & (words < size))
    if len(short):
        whole = []
        for d in short:
            key = np.array([words[d]], np.uint64)
            for h in hashes[starts[d] : ends[d]]:
                key = bk.chained(key, h)
            whole.append(key[0])
        keys, owners = np.concatenate([keys, np.array(whole, np.uint64)]), np.concatenate([owners, short])
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners = keys[new], owners[new]
    return owners, keys, np.bincount(owners, minlength=len(stops))


def _frequencies(asked: DataFrame) -> DataFrame:
    """(block, bucket, counts): how many documents hold each shingle sent."""

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [bk.sent_keys(k) for k in rows["keys"]]
        counts = np.concatenate([from_planes(c, np.uint32) for c in rows["counts"]])
        known, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(place, counts, minlength=len(known)).astype(np.uint64)[place]
        found = [bk.zipped(part) for part in np.split(totals, np.cumsum([len(k) for k in keys])[:-1])]
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "counts": found})

    return asked.groupBy("bucket").applyInPandas(sparing_group(total), "block long, bucket long, counts binary")


def signatures(blocks: DataFrame, frequencies: DataFrame, size: int) -> DataFrame:
    """(id, n, digest, keys, prefix) per document.

    `digest` names the set of a document that may have partners; it is null for all others. `keys` are the set's
    shingles that occur twice or more, rarest first, `prefix` how many of them lie in the prefix; both stand at the
    first of a block's copies only.
    """

    def sign(block_rows: pd.DataFrame, frequency_rows: pd.DataFrame) -> pd.DataFrame:
        block = next(block_rows.itertuples(index=False))
        owners, keys, n = document_sets(block, size)
        digests, lists, prefixes = [None] * len(n), [None] * len(n), [None] * len(n)
        if len(keys):
            place = np.unique(_coarse(keys), return_inverse=True)[1]
            ordered = frequency_rows.sort_values("bucket")["counts"]
            often = np.concatenate([bk.unzipped(c, np.uint64) for c in ordered])[place]
            repeated = np.bincount(owners[often > 1], minlength=len(n))
            least = -(-NUMERATOR * n // DENOMINATOR)
            prefix = (n - least + 1) - (n - repeated)
            stops = np.cumsum(n)
            seen = set()
            for d in np.flatnonzero((n > 0) & (repeated >= least)):
                own = slice(stops[d] - n[d], stops[d])
                digests[d] = xxhash.xxh3_128_digest(keys[own].tobytes())
                if digests[d] not in seen:
                    seen.add(digests[d])
                    mine, f = keys[own], often[own]
                    order = np.lexsort((mine, f))
                    lists[d] = mine[order][f[order] > 1].view(np.int64)
                    prefixes[d] = prefix[d]
        return pd.DataFrame(
            {"id": list(block.ids), "n": n, "digest": digests, "keys": lists, "prefix": pd.array(prefixes, "Int32")}
        )

    return (
        blocks.groupBy("block")
        .cogroup(frequencies.groupBy("block"))
        .applyInPandas(sparing_pair(sign), "id string, n long, digest binary, keys array<long>, prefix int")
    )


def _coarse(keys: np.ndarray) -> np.ndarray:
    return keys >> FREQUENCY_BITS << FREQUENCY_BITS


def prefix_entries(sets: DataFrame) -> DataFrame:
    """(key, rep, n, r, pos, suffix): each set's prefix shingles.

    `r` of the set's n shingles occur twice or more; `pos` is the shingle's place among them. `suffix` says how the
    shingles after it fall into parts by their hash, in small numbers that stop at `MOST`.
    """

    columns = sets.select("rep", "n", "keys", "prefix")
    schema = to_arrow_schema(StructType.fromDDL(_ENTRY))
    parts = np.arange(SUFFIX_PARTS, dtype=np.uint64)

    def entries(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, prefix = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "prefix"))
        stops, values = (x.to_numpy() for x in (batch.column("keys").offsets, batch.column("keys").values))
        sets = [values[a:b] for a, b in zip(stops, stops[1:])]
        after = []
        for keys, length in zip(sets, prefix):
            part = keys.view(np.uint64) & np.uint64(SUFFIX_PARTS - 1)
            total = np.bincount(part.astype(np.int64), minlength=SUFFIX_PARTS)
            after.append(np.minimum(total - np.cumsum(part[:length, None] == parts, axis=0), MOST).astype(np.int16))
        suffix = np.concatenate(after)
        made = {
            "key": np.concatenate([keys[:length] for keys, length in zip(sets, prefix)]),
            "rep": batch.column("rep").take(pa.array(np.repeat(np.arange(len(n)), prefix))),
            "n": np.repeat(n, prefix),
            "r": np.repeat([len(keys) for keys in sets], prefix),
            "pos": np.concatenate([np.arange(length) for length in prefix]),
            "suffix": pa.ListArray.from_arrays(
                pa.array(np.arange(len(suffix) + 1) * SUFFIX_PARTS, pa.int32()), pa.array(suffix.reshape(-1))
            ),
        }
        arrays = [pa.array(v).cast(f.type) for v, f in zip(made.values(), schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SETS_AT_ONCE):
                yield entries(batch.slice(start, SETS_AT_ONCE))

    return columns.mapInArrow(sparing(spread), _ENTRY)


# The least overlap of two linked sets: ceil((x + y) * t / (1 + t)).
_OVERLAP = f"(({NUMERATOR} * (x.n + y.n) + {NUMERATOR + DENOMINATOR - 1}) div {NUMERATOR + DENOMINATOR})"
_PAIR = ("least(x.rep, y.rep) AS a", "greatest(x.rep, y.rep) AS b")


def meeting_passes() -> Column:
    """Length, position and suffix filters on two entries x and y of one shingle.

    A shingle that occurs once is in no overlap, so positions and what may follow count the others only, and all
    that occur once are differences. The suffix filter adds up the differences that are certain: before the common
    shingle at least the difference of its positions, after it at least that of every part.
    """
    return F.expr(
        f"""{DENOMINATOR} * least(x.n, y.n) >= {NUMERATOR} * greatest(x.n, y.n)
        AND least(x.pos, y.pos) + 1 + least(x.r - x.pos - 1, y.r - y.pos - 1) >= {_OVERLAP}
        AND x.n - x.r + y.n - y.r + abs(x.pos - y.pos)
            + aggregate(zip_with(x.suffix, y.suffix, (a, b) -> abs(a - b)), 0, (s, d) -> s + d)
            <= x.n + y.n - 2 * {_OVERLAP}"""
    )


def first_meetings(entries: DataFrame) -> DataFrame:
    """(a, b): every set with the central set of each of its prefix shingles, where the filters pass.

    Central is the set with the fewest shingles of its own: of a group of edited copies, the text they came from.
    """
    central = entries.groupBy("key").agg(
        F.min(F.struct((F.col("n") - F.col("r")).alias("own"), "n", "rep", "r", "pos", "suffix")).alias("s"),
        F.count(F.lit(1)).alias("sets"),
    )
    central = written(central.filter("sets > 1").select("key", "s.*"), "join-central")
    met = entries.alias("x").join(central.alias("y"), F.expr("x.key = y.key AND x.rep <> y.rep") & meeting_passes())
    return met.selectExpr(*_PAIR).distinct()


def further_meetings(entries: DataFrame, found: DataFrame, met: DataFrame) -> DataFrame:
    """(a, b): sets of one shingle that are in different components, where the filters pass, not met before.

    `found` are the components so far. The largest component of a shingle's sets does not meet itself.
    """
    named = entries.join(found, entries["rep"] == found["node"], "left").drop("node")
    named = written(named.withColumn("component", F.coalesce("component", "rep")), "join-named")
    each = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("sets"))
    largest = each.groupBy("key").agg(
        F.max(F.struct("sets", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("components")
    )
    open_keys = written(largest.filter("components > 1").select("key", "largest"), "join-open")
    still = written(named.join(open_keys, "key"), "join-still")
    pairs = (
        still.filter("component <> largest")
        .alias("x")
        .join(still.alias("y"), F.expr("x.key = y.key AND x.component <> y.component") & meeting_passes())
        .selectExpr(*_PAIR)
        .distinct()
    )
    return written(pairs, "join-pairs").join(met, ["a", "b"], "left_anti")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough. Shingles that occur once are in no overlap."""
    x = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("keys").alias("keys_a"))
    y = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("keys").alias("keys_b"))
    overlap = F.size(F.array_intersect("keys_a", "keys_b"))
    both = pairs.join(x, "a").join(y, "b")
    return both.filter(
        overlap * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (F.col("n_a") + F.col("n_b"))
    ).select("a", "b")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", size: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id) per row."""
    spark = docs.sparkSession
    blocks = written(bk.build(docs, id_col, text_col, "0"), "join-blocks")
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = bk.buckets_for(tokens, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = bk.requests(blocks, lambda block: _coarse(document_sets(block, size)[1]), buckets)
    frequencies = written(_frequencies(asked), "join-frequencies")
    kind = docs.schema[id_col].dataType
    signed = signatures(blocks, frequencies, size).withColumn("id", F.col("id").cast(kind))
    signed = written(signed, "join-signatures")
    sets = written(
        signed.filter("digest IS NOT NULL AND id IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("id").alias("first_id"),
            F.first("n").alias("n"),
            F.first("keys", ignorenulls=True).alias("keys"),
            F.first("prefix", ignorenulls=True).alias("prefix"),
        )
        .filter("keys IS NOT NULL")
        .withColumnRenamed("digest", "rep"),
        "join-sets",
    )
    entries = written(prefix_entries(sets), "join-entries")
    met = written(first_meetings(entries), "join-met")
    links = written(verified(met, sets), "join-links")
    found = written(components(links), "join-components")
    more = written(further_meetings(entries, found, met), "join-more")
    further = verified(more, sets)
    joined = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(further)
    final = components(written(joined, "join-all"))
    members = written(
        sets.select("rep", "first_id")
        .join(final, F.col("rep") == F.col("node"), "left")
        .select("rep", "first_id", F.coalesce("component", "rep").alias("component")),
        "join-members",
    )
    smallest = written(members.groupBy("component").agg(F.min("first_id").alias("component_id")), "join-smallest")
    named = written(members.join(smallest, "component").select(F.col("rep").alias("digest"), "component_id"), "join-names")
    rows = signed.select("id", "n", "digest")
    alone = rows.filter("digest IS NULL OR id IS NULL").withColumn("component_id", F.col("id"))
    linked = rows.filter("digest IS NOT NULL AND id IS NOT NULL").join(named, "digest")
    columns = (F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
    return alone.select(*columns).unionByName(linked.select(*columns))


def _row_key(docs: DataFrame) -> Column:
    """A row's id and text as one text that sorts by id first; null without an id. Rows with equal keys are copies."""
    place = F.col("doc_id").cast("string")
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        shifted = F.col("doc_id").cast("decimal(20,0)") + F.expr("9223372036854775808BD")
        place = F.lpad(shifted.cast("string"), 20, "0")
    return F.concat(place, F.lit(":"), F.coalesce(F.hex(F.xxhash64("text")), F.lit("-")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, of each group of linked ones only that with the smallest id.

    Rows are told apart by id and text: of rows with one id and different texts each is judged by its own text, and of
    linked ones among them one stays. Rows that repeat id and text are one. Rows without an id are linked with nothing.
    Texts are joined with ids alone; only rows that share their id are joined by text as well.
    """
    key, kind = _row_key(docs), docs.schema["doc_id"].dataType
    # A row's name is its id in 20 digits or more, and 17 characters for its text.
    keyed = docs.select(key.alias("__row"), "text")
    judged = near_duplicates(keyed, "__row").filter("__row IS NOT NULL").select("__row", "component_id")
    name = F.regexp_replace("__row", ":[0-9A-F-]*$", "")
    if isinstance(kind, IntegralType):
        name = name.cast("decimal(20,0)") - F.expr("9223372036854775808BD")
    judged = written(judged.withColumn("__id", name.cast(kind)), "join-judged")
    shared = written(judged.groupBy("__id").count().filter("count > 1").select("__id"), "join-shared")
    gone = judged.filter("__row <> component_id").select("__id").distinct()
    out = written(gone.unionByName(shared).distinct().withColumnRenamed("__id", "doc_id"), "join-gone")
    single = docs.join(out, "doc_id", "left_anti").select(*docs.columns)
    theirs = judged.join(shared, "__id", "left_semi").filter("__row <> component_id").select("__row").distinct()
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")
    rows = docs.join(shared.withColumnRenamed("__id", "doc_id"), "doc_id", "left_semi").select(key.alias("__row"), packed)
    again = rows.join(theirs, "__row", "left_anti").dropDuplicates(["__row"])
    return single.unionByName(again.select("__doc.*"))
