"""How much the sources of a language differ, by a pair-task sparse merge.

Every (language, source) group gives each kept term of its language a smoothed share p in whole billionths, and so does the
language as a whole. Two groups are priced against each other over all kept terms, in both directions; each group's terms that
stand out most against its language are listed.

* **Counts.** Tasks count terms and the documents that hold them by group and send one row per group and term, so a group or a
  term with a third of everything is one row per task.
* **Pair tasks.** Term ids are numbered within shards of bounded size. A group's counts in a shard are one packed, sorted array of
  (term id, count). For every unordered pair of groups and shard the two arrays are co-grouped: the shorter array's ids are
  searched in the longer one. Terms of both, of one side only and of neither side are priced both ways; the last two need
  one price each, so the cost follows the terms that the groups have and not the vocabulary.

All arithmetic is on whole numbers: shares by long division, squares below 2^63. Null languages, sources and texts count as
empty text; a group without terms is a group. Languages without kept terms have pairs of value 0 and no term rows.
Repeated rows are documents of their own. An empty table gives an empty result. Other columns stay out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .blocks import unzipped, zipped
from .common import written

# Characters of terms, documents that a kept term has at least, the scale of shares, ranks of terms.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
# Entries that a task counts before it sends them on; terms of a shard on average.
HELD_TERMS = 300_000
SHARD_TERMS = 1 << 16

# Bytes of terms stay, A-Z in lower case; any other byte separates.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Every byte of a character beyond ASCII is above 127, so terms are cut in UTF-8."""
    return (text or "").encode().translate(_TERM_BYTES).split()


def counted(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, docs) of the terms, and a row with a null term for every group."""
    given = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    schema = pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                names = [None, *(t.decode() for t in n)]
                columns = [[lang] * len(names), [source] * len(names), names, [0, *n.values()], [0, *(docs[t] for t in n)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            groups.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                words, before = terms_of(text), len(n)
                n.update(words)
                docs.update(set(words))
                held += len(n) - before
                if held > HELD_TERMS:
                    yield from sent()
                    held = 0
        yield from sent()

    rows = docs.select(*given, F.col(text_col).alias("text"))
    made = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return made.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exact."""
    whole = lambda c: c.cast("decimal(19,0)")
    return F.expr("1L") + F.call_function("div", whole(n + 1) * F.lit(SCALE).cast("decimal(10,0)"), whole(total + kept))


def shares(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The same for an array, by long division in steps of a thousand."""
    rest, found, whole = n.astype(np.int64) + 1, np.zeros(len(n), np.int64), total + kept
    for _ in range(3):
        rest = rest * 1000
        found = found * 1000 + rest // whole
        rest = rest % whole
    return found + 1


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _packed(terms: DataFrame) -> DataFrame:
    """(lang, source, shard, ids, counts): a group's terms of a shard, sorted by id."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        ids = np.diff(rows["id"].to_numpy(np.int64), prepend=0).astype(np.uint32)
        first = rows.iloc[0]
        row = (first["lang"], first["source"], first["shard"], zipped(ids), zipped(rows["n"].to_numpy(np.uint64)))
        return pd.DataFrame([row], columns=["lang", "source", "shard", "ids", "counts"])

    given = terms.select("lang", "source", "shard", "id", "n")
    return given.groupBy("lang", "source", "shard").applyInPandas(
        pack, "lang string, source string, shard long, ids binary, counts binary"
    )


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], a_total: int, b_total: int, kept: int):
    """(union of the terms, price of a against b, price of b against a) over the terms of either side.

    Each side is (sorted ids, counts).
    """
    swapped = len(a[0]) > len(b[0])
    (few, few_n), (many, many_n) = (b, a) if swapped else (a, b)
    few_total, many_total = (b_total, a_total) if swapped else (a_total, b_total)
    at = np.searchsorted(many, few)
    common = np.zeros(len(few), bool)
    inside = at < len(many)
    common[inside] = many[at[inside]] == few[inside]
    other = np.ones(len(many), bool)
    other[at[common]] = False
    p = shares(np.concatenate([few_n, np.zeros(other.sum(), few_n.dtype)]), few_total, kept)
    facing = np.zeros(len(few), many_n.dtype)
    facing[common] = many_n[at[common]]
    q = shares(np.concatenate([facing, many_n[other]]), many_total, kept)
    ahead, back = int(prices(p, q).sum()), int(prices(q, p).sum())
    return len(p), *((back, ahead) if swapped else (ahead, back))


_SIDE = ("lang", "a", "b", "shard", "ids", "counts", "a_total", "b_total", "kept")


def _pair_sums(packed: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, a, b, terms, ahead, back) summed over the shards."""

    def merge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known = next((left if len(left) else right).itertuples(index=False))

        def side(rows):
            if not len(rows):
                return np.zeros(0, np.int64), np.zeros(0, np.uint64)
            row = next(rows.itertuples(index=False))
            return np.cumsum(unzipped(row.ids, np.uint32), dtype=np.int64), unzipped(row.counts, np.uint64)

        found = merged(side(left), side(right), known.a_total, known.b_total, known.kept)
        return pd.DataFrame([(known.lang, known.a, known.b, *found)], columns=["lang", "a", "b", "terms", "ahead", "back"])

    key = ("lang", "a", "b", "shard")
    # Both sides come from one table; new names of their own keep the columns apart.
    sides = [
        packed.withColumnRenamed("source", c).join(pairs, ["lang", c]).select(*(F.col(x).alias(x) for x in _SIDE)).groupBy(*key)
        for c in ("a", "b")
    ]
    schema = "lang string, a string, b string, terms long, ahead long, back long"
    made = sides[0].cogroup(sides[1]).applyInPandas(merge, schema)
    return made.groupBy("lang", "a", "b").agg(*(F.sum(c).alias(c) for c in ("terms", "ahead", "back")))


def audit(
    docs: DataFrame, lang_col="lang", source_col="source", text_col="text", least_docs: int = LEAST_DOCS, top: int = TOP
) -> DataFrame:
    """lang, source, part, item, value, rank: part `pair` for other sources, part `term` for terms that stand out.

    The pairs of sources of a language are the result, so they are formed; all else grows with the terms of the groups.
    """
    counts = written(counted(docs, lang_col, source_col, text_col), "divergence-counts")
    by_term = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d"))
    kept = written(by_term.filter(F.col("d") >= least_docs).drop("d"), "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    shards = max(1, math.ceil(kept.count() / SHARD_TERMS))
    numbered = kept.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("long")).withColumn(
        "id", F.row_number().over(Window.partitionBy("lang", "shard").orderBy("term"))
    )
    given = counts.filter("term is not null").select("lang", "source", "term", "n")
    terms = written(given.join(numbered, ["lang", "term"]), "divergence-terms")

    totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = written(groups.select("lang", "source", zero("total"), zero("kept"), zero("lang_total")), "divergence-groups")

    sides = [groups.select("lang", F.col("source").alias(c), F.col("total").alias(f"{c}_total"), *more) for c, more in (("a", ["kept"]), ("b", []))]
    pairs = sides[0].join(sides[1], "lang").filter("a < b")
    sums = _pair_sums(written(_packed(terms), "divergence-arrays"), pairs)
    rest = F.col("kept") - zero("terms")
    none = F.lit(0).cast("long")

    def value(p_total, q_total, over):
        p, q = (share(none, F.col(c), F.col("kept")) for c in (p_total, q_total))
        absent = rest * F.call_function("div", (p - q) * (p - q), q)
        return F.when(F.col("kept") == 0, none).otherwise(zero(over) + absent)

    directions = [
        F.struct(F.col(x).alias("source"), F.col(y).alias("item"), value(f"{x}_total", f"{y}_total", over).alias("value"))
        for x, y, over in (("a", "b", "ahead"), ("b", "a", "back"))
    ]
    both = pairs.join(sums, ["lang", "a", "b"], "left").select("lang", F.explode(F.array(*directions)).alias("d"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pair_rows = both.select("lang", "d.*").withColumn("rank", F.row_number().over(best))

    p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    priced = (
        terms.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .filter("p > q")
        .select("lang", "source", "item", F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q")).alias("value"))
    )
    term_rows = priced.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return (
        pair_rows.withColumn("part", F.lit("pair"))
        .unionByName(term_rows.withColumn("part", F.lit("term")))
        .select("lang", "source", "part", "item", "value", "rank")
    )


def oracle_sql() -> str:
    """SQL over `documents`."""
    price = "CAST((p - q) * (p - q) // q AS BIGINT)"
    one = f"1 + CAST({SCALE} AS HUGEINT) * (coalesce({{n}}, 0) + 1) // ({{total}} + v)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
words AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '{TERM}')) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= {LEAST_DOCS}),
counts AS MATERIALIZED (
SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
groups AS MATERIALIZED (
SELECT g.lang, g.source, coalesce(t.total, 0) AS total, coalesce(l.v, 0) AS v, coalesce(l.total, 0) AS lang_total
FROM (SELECT DISTINCT lang, source FROM docs) g
LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) t ON g.lang = t.lang AND g.source = t.source
LEFT JOIN (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang) l ON g.lang = l.lang),
shares AS MATERIALIZED (
SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {one.format(n="c.n", total="g.total")} AS p,
       {one.format(n="k.lang_n", total="g.lang_total")} AS lang_p
FROM groups g JOIN kept k ON g.lang = k.lang
LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
SELECT g.lang, g.source, o.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
LEFT JOIN (SELECT lang, source, item, sum({price}) AS value
           FROM (SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q
                 FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source) s
           GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.item = o.source),
parts AS (
SELECT lang, source, 'pair' AS part, item, value FROM pairs
UNION ALL
SELECT lang, source, 'term', term, {price} FROM (SELECT lang, source, term, p, lang_p AS q FROM shares WHERE n > 0 AND p > lang_p) t)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts) r
WHERE part = 'pair' OR rank <= {TOP}"""
