"""Mixing sources to target weights by capped water-filling.

A budget of words is dealt to the sources by weight. A source that would be repeated more often than the cap is
clamped there, and what is left over goes to the others by weight, until no source is above its cap. A source's target
then becomes whole repetitions of all its documents and a fractional one: documents in a seeded order up to the missing
number of words, the last of them in part.

Only DataFrame functions are used. The seeded order is cut at buckets of the order's hash; sums per bucket, in two
steps of at most 256 buckets a source, find the one bucket in which a source's fraction ends, and only that bucket is
ordered, so no task sorts a source. Null text has
size 0 and takes 0 words. The null source is a source, last in the order. Repeated rows are documents of their own.
An empty table gives an empty result. Reruns agree. Other columns pass through; columns named like a result are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACES, WORD, word_count, written

# Weights by a source's place, the budget in percent of all words, the most repetitions.
WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
MAX_EPOCHS = 2
SEED = "mix-1"
BUCKET_DIGITS = (2, 4)


def seeded(id_col: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))))


def prepared(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed=SEED) -> DataFrame:
    return docs.drop("size", "source_size", "target", "taken").withColumns(
        {"size": word_count(F.col(text_col)), "__source": F.col(source_col), "__order": seeded(F.col(id_col), seed)}
    )


def water_fill(sources: DataFrame) -> DataFrame:
    """(__source, source_size) with weight and target.

    Sources are numbered in one task, a row for each. The water level is found by rounds over the table of sources;
    a round brings two sums to the driver. Clamped sources stay clamped, so the rounds end.
    """
    place = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((place - 1) % len(WEIGHTS) + 1).cast("int"))
    table = written(
        sources.withColumns({"weight": weight, "cap": F.col("source_size") * MAX_EPOCHS}), "mixing-sources"
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    budget, level, clamped = BUDGET_PERCENT * total / 100, 0.0, None
    while True:
        above = F.col("cap") < F.col("weight") * F.lit(level)
        caps, weights, n = table.agg(
            F.sum(F.when(above, F.col("cap")).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
            F.count_if(above),
        ).first()
        if n == clamped or not weights:
            break
        clamped, level = n, (budget - caps) / weights
    return table.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)))


def _ends_in(buckets: DataFrame, open_at: DataFrame, digits: int) -> DataFrame:
    """(__source, cut, left): the longer bucket inside the given one where a source's fraction ends, and the words
    still to take in it. A source has at most 256 such buckets, so its order is short."""
    inside = (
        buckets.join(open_at.withColumnRenamed("__source", "__s"), F.expr("__source <=> __s AND startswith(__bucket, cut)"))
        .groupBy("__source", "left", F.substring("__bucket", 1, digits).alias("next"))
        .agg(F.sum("words").alias("words"))
    )
    before = F.sum("words").over(Window.partitionBy("__source").orderBy("next")) - F.col("words")
    return (
        inside.withColumn("before", before)
        .filter("before < left AND left <= before + words")
        .select("__source", (F.col("left") - F.col("before")).alias("left"), F.col("next").alias("cut"))
    )


def mix(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Prepared rows with source_size, target (double) and taken (words, repeats counted).

    The rows are read three times: for the sums, for those that are taken whole, and for the few where a fraction ends.
    """
    rows = rows.withColumn("__bucket", F.substring("__order", 1, BUCKET_DIGITS[-1]))
    buckets = written(rows.groupBy("__source", "__bucket").agg(F.sum("size").alias("words")), "mixing-buckets")
    sources = buckets.groupBy("__source").agg(F.sum("words").alias("source_size"))
    filled = water_fill(sources)
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    planned = filled.withColumn("epochs", epochs.cast("long")).withColumn(
        "missing", F.round("target").cast("long") - F.col("epochs") * F.col("source_size")
    )
    open_at = planned.select("__source", F.col("missing").alias("left"), F.lit("").alias("cut"))
    for digits in BUCKET_DIGITS:
        open_at = written(_ends_in(buckets, open_at, digits), "mixing-ends")
    cut = open_at.withColumnRenamed("__source", "__s")
    steer = written(
        planned.join(cut, F.expr("__source <=> __s"), "left").select(
            F.col("__source").alias("__key"),
            "source_size",
            "target",
            F.col("epochs").alias("__epochs"),
            F.coalesce("cut", F.lit("")).alias("__cut"),
            F.coalesce("left", F.lit(0)).alias("__left"),
        ),
        "mixing-cuts",
    )
    joined = rows.join(steer, F.expr("__source <=> __key"))
    clear = joined.filter("__bucket <> __cut").withColumn(
        "__extra", F.when(F.expr("__bucket < __cut"), F.col("size")).otherwise(F.lit(0))
    )
    order = Window.partitionBy("__source").orderBy("__order", id_col, "size").rowsBetween(Window.unboundedPreceding, 0)
    ending = (
        joined.filter("__bucket = __cut")
        .withColumn("__until", F.sum("size").over(order))
        .withColumn("__extra", F.greatest(F.lit(0), F.least("size", F.expr("__left - (__until - size)"))))
        .drop("__until")
    )
    return (
        clear.unionByName(ending)
        .withColumns({"taken": F.expr("__epochs * size + __extra")})
        .drop("__key", "__cut", "__left", "__bucket", "__order")
    )


def sample(docs: DataFrame) -> DataFrame:
    """The mix itself: documents repeated as taken, the one that ends a source's fraction cut to its words."""
    names = docs.columns
    carried = docs.select(*[F.col(f"`{c}`").alias(f"__carried_{k}") for k, c in enumerate(names)], "doc_id", "text", "source")
    mixed = mix(prepared(carried))
    pieces = F.regexp_extract_all("text", F.lit(f"[{SPACES}]*{WORD}"), F.lit(0))
    part = F.when(
        (F.col("__extra") > 0) & (F.col("__extra") < F.col("size")),
        F.array_join(F.slice(pieces, 1, F.col("__extra").cast("int")), ""),
    ).otherwise(F.col("text"))
    whole = F.array_repeat(F.col("text"), F.col("__epochs").cast("int"))
    copies = F.concat(whole, F.when(F.col("__extra") > 0, F.array(part)).otherwise(F.expr("array()")))
    made = {"text": F.col("__copy")}
    if "n_chars" in names:
        made["n_chars"] = F.char_length("__copy").cast(docs.schema["n_chars"].dataType)
    out = mixed.withColumn("__copy", F.explode(copies))
    return out.select(*(made.get(c, F.col(f"__carried_{k}")).alias(c) for k, c in enumerate(names)))


def oracle_sql() -> str:
    return f"""
WITH d AS (SELECT doc_id, source, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS o,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap,
             [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight FROM s),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
                 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, source)),
f AS (SELECT source, source_size,
             least(cap::DOUBLE, weight * (SELECT arg_min(level, cap::DOUBLE / weight) FROM l WHERE cap::DOUBLE / weight >= level)) AS target FROM w),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM f),
r AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs,
             CAST(round(p.target) AS BIGINT) - p.epochs * p.source_size AS missing,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, missing - before)) AS BIGINT) AS taken
FROM r"""
