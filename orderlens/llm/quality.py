"""Quality rules with thresholds learned per language and source.

Every document gets integer measures. Per (language, source) and measure a quantile sketch is built: counts by
log-linear cell, exact below 128 and within 1/64 beyond. Sketches merge by adding counts, so a hot source leaves each
map task as a few hundred rows. Two quantiles read off a sketch give a fence: the distance between them, some times over,
beyond the outer one. The documents are joined with the fences of their group. Every group's quantiles are mixed with its
language's, and those with all documents', by weights that grow with the number of documents, so that a small group
is judged mostly by its language and no size is a switch.

What a fence counts comes in whole events; a few of them are no evidence in a short text and are free in any.

Only DataFrame functions are used. Null text has no words. Null language and null source are groups of their own.
Repeated rows count and are judged each. An empty table gives an empty result. Other columns pass through whatever they are
called; in `judge`, columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, written

# The symbols counted, and the base limits.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


@dataclass(frozen=True)
class Fence:
    """Beyond the `upper` percentile by `reach` times its distance from the `lower` one, a measure is an outlier.

    `low` puts the same fence below the lower percentile. `free` events per text do not count. The distance is two units at least,
    the rounding of the sketch.
    """

    measure: str
    lower: int
    upper: int
    reach: int
    free: int = 0
    low: bool = False


FENCES = (
    Fence("mean_chars", 25, 75, 8, low=True),  # hundredths of code points a word
    Fence("symbols", 50, 75, 8, free=5),  # per thousand words
    Fence("dup_lines", 50, 95, 4, free=3),  # per thousand lines with a word
    Fence("repeats", 50, 95, 8, free=40),  # per thousand words
)
LEAST = 2
# Documents that the language weighs in a source's quantiles, and all documents in a language's.
PRIOR = 200

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Measured as well: the lines that hold a word.
LINES = "n_lines"
RESULTS = (*MEASURES, "base_failed", "kept")
# The count, its scale and what it is per, of each ratio.
RATIOS = {
    "mean_chars": ("word_chars", 100, "n_words"),
    "symbols": ("n_symbols", 1000, "n_words"),
    "dup_lines": ("n_dup_lines", 1000, LINES),
    "repeats": ("n_repeat_words", 1000, "n_words"),
}


def _let(value: Column, body) -> Column:
    """Evaluates a column once for all uses in the body."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, linear for texts without any.

    Windows are compared by hash first: where all hashes differ, all windows do. Else the windows themselves are
    sorted, equal neighbours marked, and each marked window adds the words not added by the marked one before it.
    """

    def exact(ws: Column) -> Column:
        windows = F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(ws) - 3),
                lambda i: F.struct(
                    F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("w"), i.alias("i")
                ),
            )
        )

        def places(sorted_windows: Column) -> Column:
            marked = F.transform(
                sorted_windows,
                lambda x, j: F.when(
                    (x["w"] == F.get(sorted_windows, j - 1)["w"]) | (x["w"] == F.get(sorted_windows, j + 1)["w"]),
                    x["i"],
                ),
            )
            return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

        def total(at: Column) -> Column:
            added = F.transform(at, lambda i, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - i, F.lit(3))))
            return F.aggregate(added, F.lit(0), lambda a, x: a + x)

        return _let(_let(windows, places), total)

    def counted(ws: Column) -> Column:
        hashes = F.transform(
            F.slice(ws, 1, F.size(ws) - 2),
            lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)),
        )
        differ = _let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
        return F.when(F.size(ws) < 3, 0).when(differ, 0).otherwise(exact(ws))

    return _let(words, counted)


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with the five base measures and the lines (long) of the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.char_length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            _repeat_words(ws).cast("long").alias("n_repeat_words"),
        )

    def of_lines(x: Column) -> Column:
        n = F.size(x).cast("long")
        return F.struct((n - F.size(F.array_distinct(x))).alias("n_dup_lines"), n.alias(LINES))

    def row(m: Column, l: Column) -> Column:
        return F.struct(
            m["n_words"].alias("n_words"),
            m["word_chars"].alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            l["n_dup_lines"].alias("n_dup_lines"),
            m["n_repeat_words"].alias("n_repeat_words"),
            l[LINES].alias(LINES),
        )

    # Generated columns are made once: no filter on them moves below the generator and measures the text again.
    both = F.array(F.struct(_let(words, of_words).alias("m"), _let(lines, of_lines).alias("l")))
    return docs.drop(*MEASURES, LINES).select("*", F.inline(F.transform(both, lambda b: row(b["m"], b["l"]))))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _ratios() -> dict[str, Column]:
    return {k: F.expr(f"({count} * {scale}L) div greatest({per}, 1L)") for k, (count, scale, per) in RATIOS.items()}


def cell(value: Column) -> Column:
    """Lower end of a value's log-linear cell: the seven highest bits."""
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    size = F.pow(F.lit(2), shift).cast("long")
    return value - value % size


def sketches(measures: DataFrame, group: list[str]) -> DataFrame:
    """(group, measure, cell, n): one mergeable quantile sketch per group and measure.

    Documents that fail the base rules are no evidence of what is normal and stay out.
    """
    ratios = _ratios()
    named = F.explode(
        F.array(*(F.struct(F.lit(k).alias("measure"), cell(v).alias("cell")) for k, v in ratios.items()))
    )
    return (
        measures.filter(~base_failed())
        .select(*group, named.alias("m"))
        .groupBy(*group, "m.measure", "m.cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(parts: DataFrame, group: list[str]) -> DataFrame:
    """Sketches of coarser groups: counts of equal cells added."""
    return parts.groupBy(*group, "measure", "cell").agg(F.sum("n").alias("n"))


def quantiles(parts: DataFrame, group: list[str]) -> DataFrame:
    """(group, measure, total, lower, upper): the cells that reach the percentiles of the measure's fence.

    A sketch has a bounded number of cells, so one row of arrays holds it.
    """
    held = parts.groupBy(*group, "measure").agg(
        F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("cells")
    )

    def percentile(which: str) -> Column:
        part = F.coalesce(*(F.when(F.col("measure") == f.measure, F.lit(getattr(f, which))) for f in FENCES))
        start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("at"))

        def step(acc, x):
            total = acc["sum"] + x["n"]
            reached = F.when(100 * total >= part * F.col("total"), x["cell"])
            return F.struct(total.alias("sum"), F.coalesce(acc["at"], reached).alias("at"))

        return F.aggregate("cells", start, step, lambda acc: acc["at"])

    return held.select(*group, "measure", "total", percentile("lower").alias("lower"), percentile("upper").alias("upper"))


def thresholds(measures: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """One row per (language, source), `__lang` and `__source`, with the fences from its quantiles and those above it."""
    groups = ["__lang", "__source"]
    keyed = measures.select(*MEASURES, LINES, F.col(lang_col).alias("__lang"), F.col(source_col).alias("__source"))
    fine = written(sketches(keyed, groups), "quality-sketches")
    by_lang = merge(fine, ["__lang"])
    own = quantiles(fine, groups)
    lang = quantiles(by_lang, ["__lang"])
    every = quantiles(merge(by_lang, []), [])

    def renamed(df, suffix):
        return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in ("total", "lower", "upper")})

    wide = (
        own.alias("o")
        .join(
            renamed(lang, "lang").withColumnsRenamed({"__lang": "__l", "measure": "__ml"}),
            F.expr("o.__lang <=> __l AND o.measure = __ml"),
        )
        .join(renamed(every, "all").withColumnRenamed("measure", "__ma"), F.expr("o.measure = __ma"))
    )

    def mixed(name):
        above = f"((total_lang * {name}_lang + {PRIOR} * {name}_all) div (total_lang + {PRIOR}))"
        return F.expr(f"(total * {name} + {PRIOR} * {above}) div (total + {PRIOR})").alias(name)

    picked = wide.select(*groups, "measure", mixed("lower"), mixed("upper"))
    ends = []
    for f in FENCES:
        here = F.col("measure") == f.measure
        far = f.reach * F.greatest(F.col("upper") - F.col("lower"), F.lit(LEAST).cast("long"))
        if f.low:
            ends.append(F.max(F.when(here, F.col("lower") - far)).alias(f"{f.measure}_low"))
        ends.append(F.max(F.when(here, F.col("upper") + far)).alias(f"{f.measure}_high"))
    return picked.groupBy(*groups).agg(*ends)


def _carried(docs: DataFrame, names: list[str], text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """The columns to pass through under names of their own, and what is judged."""
    asked = [F.col(f"`{c}`").alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))]
    return docs.select(*[F.col(f"`{c}`").alias(f"__carried_{k}") for k, c in enumerate(names)], *asked)


def _back(rows: DataFrame, names: list[str], *more: str) -> DataFrame:
    return rows.select(*[F.col(f"__carried_{k}").alias(c) for k, c in enumerate(names)], *more)


def judge(docs: DataFrame, text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """The documents without their text, with their measures, `base_failed` and `kept`.

    Measuring is the costly step, so the measured rows are written once, and both the sketches and the judgement
    read them.
    """
    names = [c for c in docs.columns if c not in RESULTS and c != text_col]
    measures = written(measured(_carried(docs, names, text_col, lang_col, source_col)).drop("text"), "quality-measures")
    return _back(judged(measures, fences(measures)), names, *RESULTS)


def fences(measures: DataFrame, lang_col="lang", source_col="source") -> DataFrame:
    found = thresholds(measures.select(lang_col, source_col, *MEASURES, LINES), lang_col, source_col)
    return written(found, "quality-fences")


def judged(measures: DataFrame, limits: DataFrame, lang_col="lang", source_col="source") -> DataFrame:
    """Measured rows with the verdict of the base rules and of their group's fences, one row per (language, source)."""
    rules = []
    for f in FENCES:
        count, scale, per = RATIOS[f.measure]
        if f.low:
            rules.append(_ratios()[f.measure] < F.col(f"{f.measure}_low"))
        # Compared without a division, so that free events do not depend on its rounding.
        rules.append((F.col(count) - f.free) * scale >= (F.col(f"{f.measure}_high") + 1) * F.greatest(F.col(per), F.lit(1)))
    outlier = F.coalesce(F.greatest(*rules), F.lit(False))
    same = F.col(lang_col).eqNullSafe(F.col("__lang")) & F.col(source_col).eqNullSafe(F.col("__source"))
    names = measures.columns
    return (
        measures.join(limits, same, "left")
        .select(*names, base_failed().alias("base_failed"), outlier.alias("__outlier"))
        .select(*names, "base_failed", (~F.col("base_failed") & ~F.col("__outlier")).alias("kept"))
    )


def kept(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns.

    Texts are measured twice, for the fences and for the verdicts, rather than written beside their measures.
    """
    names = docs.columns
    measures = measured(_carried(docs, names, "text", "lang", "source"))
    return _back(judged(measures, fences(measures)).filter("kept"), names)


def oracle_sql() -> str:
    """Measures, sketches, fences and verdicts from the definitions."""
    value = {k: f"({count} * {scale}) // greatest({per}, 1)" for k, (count, scale, per) in RATIOS.items()}
    measures = " UNION ALL ".join(
        f"SELECT lang, source, '{k}' AS measure, {v} AS value FROM m WHERE NOT base_failed" for k, v in value.items()
    )
    percents = {w: " ".join(f"WHEN '{f.measure}' THEN {getattr(f, w)}" for f in FENCES) for w in ("lower", "upper")}

    def quantile_view(name, group):
        columns = "".join(f"{g}, " for g in group)
        reached = ", ".join(
            f"min(CASE WHEN 100 * run >= (CASE measure {whens} END) * total THEN cell END) AS {w}" for w, whens in percents.items()
        )
        return f"""
{name} AS (SELECT {columns}measure, max(total) AS total, {reached}
  FROM (SELECT {columns}measure, cell, sum(n) OVER (PARTITION BY {columns}measure ORDER BY cell) AS run,
               sum(n) OVER (PARTITION BY {columns}measure) AS total
        FROM (SELECT {columns}measure, cell, sum(n) AS n FROM sketch GROUP BY ALL) s) t
  GROUP BY ALL)"""

    def mixed(q):
        above = f"((l.total * l.{q} + {PRIOR} * a.{q}) // (l.total + {PRIOR}))"
        return f"(o.total * o.{q} + {PRIOR} * {above}) // (o.total + {PRIOR}) AS {q}"

    tests = []
    for f in FENCES:
        count, scale, per = RATIOS[f.measure]
        far = f"{f.reach} * greatest(upper - lower, {LEAST})"
        if f.low:
            tests.append(f"(f.measure = '{f.measure}' AND {value[f.measure]} < lower - {far})")
        high = f"({count} - {f.free}) * {scale} >= (upper + {far} + 1) * greatest({per}, 1)"
        tests.append(f"(f.measure = '{f.measure}' AND {high})")
    word = "'[^\\x20\\x09-\\x0D]+'"
    return f"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), {word}) AS ws FROM documents),
places AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM t),
windows AS (SELECT doc_id, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM places
            WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
marked AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS n FROM windows WHERE w3 IS NOT NULL),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM marked, (SELECT unnest([0, 1, 2]) AS k) s
            WHERE n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n, count(*) AS n_lines
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) s
          WHERE regexp_matches(line, {word}) GROUP BY doc_id),
m0 AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
              CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
              CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
              coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
       FROM t LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m0),
sketch AS (SELECT lang, source, measure, cell, count(*) AS n
           FROM (SELECT lang, source, measure,
                        value - value % CAST(pow(2, greatest(length(bin(value)) - 7, 0)) AS BIGINT) AS cell
                 FROM ({measures}) v) c GROUP BY ALL),
{quantile_view("own", ("lang", "source"))},
{quantile_view("by_lang", ("lang",))},
{quantile_view("every", ())},
fences AS (SELECT o.lang, o.source, o.measure, {mixed("lower")}, {mixed("upper")}
           FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure
           JOIN every a ON o.measure = a.measure),
outliers AS (SELECT DISTINCT doc_id FROM m JOIN fences f ON m.lang IS NOT DISTINCT FROM f.lang
                    AND m.source IS NOT DISTINCT FROM f.source WHERE {" OR ".join(tests)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outliers) AS kept
FROM m"""
