"""Merkle manifest of a table, with incremental witnesses.

A row's leaf hashes its columns with their lengths. The rows of a group (a source) in the order of their ids are the leaves
of a tree of 16 branches; a run of 16 nodes becomes their hash while a level has more than one node, and the last run may
be shorter. The groups' roots in the order of the groups are the leaves of one more such tree, whose root names the table.

* **Aligned append.** A group's sequence is cut into blocks of 16^2 places. A task streams a block's digests through an
  `Appender`: every digest gets a partial witness, the open run it stands in; when the last sibling of a run arrives, the run's
  hash is appended one level up, which extends the witnesses of all leaves below it. Witnesses share their runs.
* **Distributed block roots.** Block roots are appended to the next stage in the same way until a group has one root.
  A way down hands every block the witness of its own root, which extends those of its leaves. So no task holds more than a
  block, whatever share of the rows a group has, and a stage has a 256th of the rows of the one before.
* **Places.** Rows are ranged by (group, id, leaf); places add up over the ranges. Copies of a row are one
  row with a count until they are put into blocks, so a row that makes up a third of the table is no large range.

Null columns are hashed as `-`. Null groups come first, then groups by their bytes; null ids come first in their group, rows
of one id stand in the order of their leaves, so every copy has its own place and all results are the same on any
partitioning. An empty table gives empty frames. Columns that are not named stay out, whatever they are called.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

BRANCHES, LEVELS = 16, 2
BLOCK = BRANCHES**LEVELS
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RANGE_ROWS = 1 << 18
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def node(digests: bytes) -> bytes:
    """The hash over nodes, whose digests are hashed as hex text."""
    return hashlib.sha256(digests.hex().encode()).digest()


class Appender:
    """An aligned tree that grows by one digest at a time; `levels` is how many levels the block has.

    The witness of leaf i on level k is the run `closed[k][i // 16^(k+1)]`, or the open run while siblings are missing.
    """

    def __init__(self, levels: int):
        self.open = [bytearray() for _ in range(levels + 1)]
        self.closed: list[list[bytes]] = [[] for _ in range(levels)]

    def append(self, digest: bytes, level: int = 0) -> None:
        self.open[level] += digest
        if level < len(self.closed) and len(self.open[level]) == BRANCHES * DIGEST:
            self._close(level)

    def _close(self, level: int) -> None:
        run = bytes(self.open[level])
        self.open[level].clear()
        self.closed[level].append(run)
        self.append(node(run), level + 1)

    def finish(self) -> bytes:
        """Closes the runs at the right edge; the root."""
        for level in range(len(self.closed)):
            if self.open[level]:
                self._close(level)
        return bytes(self.open[-1])


def witness(closed: Sequence[Sequence[bytes]], place: int) -> bytes:
    """For every level the place among the siblings, their number, and their digests from left to right."""
    out = bytearray()
    for runs in closed:
        up, at = divmod(place, BRANCHES)
        run = runs[up]
        out += bytes((at, len(run) // DIGEST - 1)) + run[: at * DIGEST] + run[(at + 1) * DIGEST :]
        place = up
    return bytes(out)


def _steps(path: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(path):
        place, siblings = path[at], path[at + 1] * DIGEST
        yield place * DIGEST, path[at + 2 : at + 2 + siblings]
        at += 2 + siblings


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its witness give."""
    for cut, siblings in _steps(path):
        digest = node(siblings[:cut] + digest + siblings[cut:])
    return digest


def levels_of(total: int) -> int:
    """Levels of the blocks of a sequence of so many nodes."""
    levels = 0
    while total > 1 and levels < LEVELS:
        total, levels = math.ceil(total / BRANCHES), levels + 1
    return levels


def leaf_of(fields: Sequence[Column]) -> Column:
    """SHA-256 over columns: `-` for null, else the number of bytes, `:` and the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def lowered(text: Column) -> Column:
    return F.translate(text, LETTERS, LETTERS.lower())


def _key(group: Column) -> Column:
    """A text that is never null and sorts as null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit(""))


def _placed(items: DataFrame) -> DataFrame:
    """(grp, id, digest, altered, first, copies, total): how many of the group stand before each row, and in all."""
    spark = items.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(items.count() / RANGE_ROWS))
    order = ["grp", "id", "digest", "altered"]
    ranged = items.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, upto = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            inside = []
            for name, copies in zip(batch.column("grp").to_pylist(), batch.column("copies").to_pylist()):
                if name != group:
                    group, upto = name, 0
                inside.append(upto)
                upto += copies
            added = [pa.array([part] * len(inside), pa.int64()), pa.array(inside, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "part", "inside"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema.fields)
    numbered = written(ranged.mapInArrow(number, f"{schema}, part long, inside long"), "merkle-ranges")
    sums = numbered.groupBy("grp", "part").agg(F.sum("copies").alias("n"))
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("part")) - F.col("n")
    offsets = sums.select("grp", "part", before.alias("before"), F.sum("n").over(Window.partitionBy("grp")).alias("total"))
    return numbered.join(offsets, ["grp", "part"]).select(
        "grp", "id", "digest", "altered", (F.col("before") + F.col("inside")).alias("first"), "copies", "total"
    )


_BLOCK = "grp string, block long, total long, ids array<string>, digests binary, altered array<binary>, root binary"


def _blocks(placed: DataFrame) -> DataFrame:
    """One row per block of a group: its digests, and its root."""
    last = F.expr(f"(first + copies - 1) div {BLOCK}")
    spread = placed.withColumn("block", F.explode(F.sequence(F.expr(f"first div {BLOCK}"), last))).select(
        "grp", "block", "total", "first", "copies", F.col("id").cast("string").alias("id"), "digest", "altered"
    )
    order = ["grp", "block", "first"]
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.list_(pa.binary()), pa.binary()]

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree, held = None, None, None

        def closed() -> pa.RecordBatch:
            ids, digests, altered = held
            row = [*at, ids, bytes(digests), altered, tree.finish()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for group, block, total, first, copies, name, digest, altered in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (group, block, total):
                    if at:
                        yield closed()
                    at, tree, held = (group, block, total), Appender(levels_of(total)), ([], bytearray(), [])
                here = min(first + copies, (block + 1) * BLOCK) - max(first, block * BLOCK)
                held[0].extend([name] * here)
                held[1].extend(digest * here)
                held[2].extend([altered] * here)
                for _ in range(here):
                    tree.append(digest)
        if at:
            yield closed()

    return spread.repartition("grp", "block").sortWithinPartitions(*order).mapInArrow(append, _BLOCK)


def _tree(items: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stages of blocks of all groups, from the leaves up, and (grp, root, stage): where each group ends."""
    stages, tops, placed = [], [], _placed(items)
    while True:
        blocks = written(_blocks(placed), "merkle-blocks")
        ended = F.col("total") <= BLOCK
        tops.append(blocks.filter(ended).select("grp", "root", F.lit(len(stages)).alias("stage")))
        stages.append(blocks)
        above = blocks.filter(~ended)
        if above.limit(1).count() == 0:
            found = tops[0]
            for more in tops[1:]:
                found = found.unionByName(more)
            return stages, found
        placed = above.select(
            "grp",
            F.lit(None).cast("string").alias("id"),
            F.col("root").alias("digest"),
            F.lit(None).cast("binary").alias("altered"),
            F.col("block").alias("first"),
            F.lit(1).cast("long").alias("copies"),
            F.ceil(F.col("total") / BLOCK).alias("total"),
        )


def _handed_down(blocks: DataFrame, paths: DataFrame, schema: str, rows_of) -> DataFrame:
    """Rows that `rows_of` makes for each node of a block, given the witness of its root."""

    def hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                digests, tree = row["digests"], Appender(levels_of(row["total"]))
                nodes = [digests[k : k + DIGEST] for k in range(0, len(digests), DIGEST)]
                for digest in nodes:
                    tree.append(digest)
                tree.finish()
                paths = (witness(tree.closed, k) + row["path"] for k in range(len(nodes)))
                made = [rows_of(row, k, digest, path) for k, (digest, path) in enumerate(zip(nodes, paths))]
                yield pa.RecordBatch.from_pylist(made, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return blocks.join(paths, ["grp", "block"]).mapInArrow(hand, schema)


def _bottom(stages: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(grp, block, path, top, root) of the blocks of leaves; `tops` has (grp, stage, path, top, root)."""
    paths = None
    for stage in reversed(range(len(stages))):
        here = tops.filter(F.col("stage") == stage).select("grp", F.lit(0).cast("long").alias("block"), "path", "top", "root")
        paths = here if paths is None else paths.unionByName(here)
        if stage:

            def child(row, k, digest, path):
                return {"grp": row["grp"], "block": row["block"] * BLOCK + k, "path": path, "top": row["top"], "root": row["top_root"]}

            above = paths.withColumnRenamed("root", "top_root")
            schema = "grp string, block long, path binary, top binary, root binary"
            paths = written(_handed_down(stages[stage], above, schema, child), "merkle-paths")
    return paths


@dataclass(frozen=True)
class Manifest:
    """A table's tree: stages of blocks, the groups' roots (`grp`, `root`, `path` to the table's root), the root or null."""

    id_type: str
    stages: list[DataFrame]
    tops: DataFrame
    root: bytes | None


def manifest(
    docs: DataFrame, id_col="doc_id", group_col="source", fields: Sequence[str] = FIELDS, altered: dict[str, Column] | None = None
) -> Manifest:
    """The manifest over the named columns. Only its root reaches the driver.

    `altered` names columns with other values; rows where that changes nothing but null to null carry the other leaf as well,
    to be folded against the original tree. A null value in it means that the row stands as it is.
    """
    other = F.lit(None).cast("binary")
    if altered:
        stays = [a.isNull() for a in altered.values()]
        changed = leaf_of([altered.get(c, F.col(c)) for c in fields])
        other = F.when(~stays[0], changed)
    rows = docs.select(_key(F.col(group_col)).alias("grp"), F.col(id_col).alias("id"), leaf_of([F.col(c) for c in fields]).alias("digest"), other.alias("altered"))
    leaves = written(rows.groupBy("grp", "id", "digest", "altered").agg(F.count(F.lit(1)).alias("copies")), "merkle-leaves")
    stages, tops = _tree(leaves)
    subroots = written(tops, "merkle-subroots")
    groups = subroots.select(
        F.lit("").alias("grp"),
        F.col("grp").alias("id"),
        F.col("root").alias("digest"),
        F.lit(None).cast("binary").alias("altered"),
        F.lit(1).cast("long").alias("copies"),
    )
    above, top = _tree(written(groups, "merkle-groups"))
    top_row = top.first()
    empty = F.lit(b"")
    start = top.select("grp", "stage", empty.alias("path"), F.col("root").alias("top"), "root")
    schema = "grp string, path binary, table_root binary"

    def of_group(row, k, digest, path):
        return {"grp": row["ids"][k], "path": path, "table_root": row["top_root"]}

    paths = _bottom(above, start).withColumnRenamed("root", "top_root")
    known = _handed_down(above[0], paths, schema, of_group)
    tops = written(subroots.join(known, "grp"), "merkle-tops")
    return Manifest(docs.schema[id_col].dataType.simpleString(), stages, tops, top_row and bytes(top_row["root"]))


def witnesses(made: Manifest, id_col="doc_id") -> DataFrame:
    """id, leaf, altered (the other leaf or null), subroot, root (all binary) and witness of every row of the table."""
    tops = made.tops.select("grp", "stage", "path", F.col("root").alias("top"), F.col("table_root").alias("root"))

    def of_leaf(row, k, digest, path):
        return {"id": row["ids"][k], "leaf": digest, "altered": row["altered"][k], "subroot": row["top"], "root": row["top_root"], "witness": path}

    schema = "id string, leaf binary, altered binary, subroot binary, root binary, witness binary"
    paths = _bottom(made.stages, tops).withColumnRenamed("root", "top_root")
    rows = _handed_down(made.stages[0], paths, schema, of_leaf)
    return rows.select(F.col("id").cast(made.id_type).alias(id_col), *rows.columns[1:])


def checked(witnessed: DataFrame) -> DataFrame:
    """The rows with proof_sha256 (the hash of the siblings) and folded_root (from the altered leaf where there is one)."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in witnessed.schema.fields)
    names = [*witnessed.columns, "proof_sha256", "folded_root"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            proofs, roots = [], []
            columns = (batch.column(c).to_pylist() for c in ("leaf", "altered", "witness"))
            for leaf, altered, path in zip(*columns):
                proofs.append(node(b"".join(siblings for _, siblings in _steps(path))).hex())
                roots.append(folded(altered or leaf, path))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(proofs, pa.string()), pa.array(roots, pa.binary())], names=names)

    return witnessed.mapInArrow(check, f"{schema}, proof_sha256 string, folded_root binary")


def audit(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Every row's leaf, roots and proof, and whether its fold still gives the root where the text was tampered with.

    Tampering lower-cases A-Z of the text of rows whose id's CRC-32 is divisible by 5; null texts and null ids stay.
    """
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    made = manifest(docs, id_col, altered={text_col: F.when(hit, lowered(F.col(text_col)))})
    rows = checked(witnesses(made, id_col))
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return rows.select(
        id_col, text("leaf"), text("subroot"), text("root"), "proof_sha256", text("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def oracle_sql(levels: int = 5, tops: int = 4) -> str:
    """SQL over `documents`, for 16^levels rows a source and 16^tops sources at most."""
    field = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"

    def leaf(text):
        columns = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(field.format(c) for c in columns) + ")"

    bits = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = "list_transform(range(1, length(d) + 1), lambda k: CAST(ascii(d[k]) AS BIGINT))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {bits}), 4294967295)"
    lower = f"translate(text, '{LETTERS}', '{LETTERS.lower()}')"
    steps = [
        f"""crcs AS MATERIALIZED (SELECT i.doc_id AS hashed_id, {crc} AS crc FROM (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS d FROM documents) i)""",
        f"""leaves AS MATERIALIZED (
SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, altered) - 1 AS p0
FROM (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND crc % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS altered
      FROM documents d LEFT JOIN crcs c ON d.doc_id IS NOT DISTINCT FROM c.hashed_id) l)""",
        "s0 AS (SELECT source AS g, p0 AS p, count(*) OVER (PARTITION BY source) AS n, leaf AS h FROM leaves)",
    ]

    def tree(name, count):
        for k in range(count):
            steps.append(
                f"""{name}r{k} AS MATERIALIZED (
SELECT g, p // 16 AS up, any_value(n) AS n, list(h ORDER BY p) AS run FROM {name}{k} GROUP BY g, p // 16)"""
            )
            steps.append(
                f"""{name}{k + 1} AS MATERIALIZED (
SELECT g, up AS p, CAST(ceil(n / 16.0) AS BIGINT) AS n, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h
FROM {name}r{k})"""
            )

    tree("s", levels)
    steps.append(
        f"""t0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS p, count(*) OVER () AS n, h FROM s{levels})"""
    )
    steps.append(f"named AS (SELECT g AS source, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS q0 FROM s{levels})")
    tree("t", tops)
    steps.append(
        f"""w0 AS (SELECT l.*, n.subroot, n.q0, t.h AS root, '' AS proof, l.altered AS f
FROM leaves l JOIN named n ON l.source IS NOT DISTINCT FROM n.source CROSS JOIN t{tops} t)"""
    )
    at = 0
    for name, count, place in (("s", levels, "p0"), ("t", tops, "q0")):
        for k in range(count):
            own = f"({place} // {16**k})"
            join = "r.g IS NOT DISTINCT FROM w.source" if name == "s" else "true"
            steps.append(
                f"""w{at + 1} AS (
SELECT w.* REPLACE (CASE WHEN n > 1 THEN proof || l || m ELSE proof END AS proof, CASE WHEN n > 1 THEN sha256(l || f || m) ELSE f END AS f)
FROM w{at} w JOIN {name}r{k} r ON {join} AND {own} // 16 = r.up,
     LATERAL (SELECT coalesce(array_to_string(run[1:{own} % 16], ''), '') AS l, coalesce(array_to_string(run[{own} % 16 + 2:], ''), '') AS m) x)"""
            )
            at += 1
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM w{at}"""
    )
