from __future__ import annotations

from orderlens.llm import quality
from support import docs_table, same, sql_rows

COLUMNS = ("doc_id", *quality.MEASURES, "base_failed", "kept")


def prose(i, n=60):
    return " ".join(f"w{(i * 7919 + k * 104729) % 99991}" for k in range(n))


def rows():
    out = [(i, prose(i), "en" if i % 3 else "fr", f"s{i % 2}") for i in range(500)]
    out += [(500 + i, prose(i), None if i % 2 else "xx", None if i % 3 else "few") for i in range(30)]
    odd = [
        None,
        "",
        " \t\n\x0b\x0c\r",
        "a b",
        "a b c",
        "a b c a b c a b",
        "same words here " * 40,
        "line one\n" * 50 + prose(7),
        prose(3) + " #*$%&|<> |||| ####" * 20,
        "x" * 500 + " " + prose(9),
        "\n".join(["", " ", "é\u00a0ü", "é\u00a0ü"]) + prose(4),
        " ".join(str(k % 17000) for k in range(20_000)),
        "z" * 300_000,
    ]
    out += [(900 + i, t, "en", "s0") for i, t in enumerate(odd)]
    return out


def test_against_sql(spark):
    table = docs_table(spark, rows())
    judged = quality.judge(table).select(*COLUMNS)
    same(judged, *sql_rows(quality.oracle_sql(), documents=table))


def test_kept_passes_rows_through(spark):
    table = docs_table(spark, [*rows(), rows()[5], (None, prose(1), "en", "s0")])
    judged = {r.doc_id: r.kept for r in quality.judge(table).select("doc_id", "kept").collect()}
    kept = quality.kept(table)
    assert kept.columns == table.columns
    got = sorted(str(r.doc_id) for r in kept.collect())
    want = [str(i) for i, k in judged.items() if k] + [str(rows()[5][0])]
    assert got == sorted(want)
    assert kept.first().kept == "z"


def test_ordinary_texts_stay(spark):
    judged = quality.judge(docs_table(spark, [(i, prose(i), "en", "s") for i in range(400)]))
    assert judged.filter("not kept").count() == 0


def test_sketches_merge(spark):
    measures = quality.measured(docs_table(spark, rows())).cache()
    whole = quality.sketches(measures, [])
    parts = quality.merge(quality.sketches(measures, ["lang", "source"]), [])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_cells_are_close(spark):
    df = spark.range(0, 100_000, 7).select("id", quality.cell(quality.F.col("id")).alias("c"))
    assert df.filter("c > id OR id - c > id / 64 OR (id < 128 AND c <> id)").count() == 0


def test_empty_table(spark):
    empty = docs_table(spark, [])
    assert quality.judge(empty).count() == 0
    assert quality.kept(empty).count() == 0


def pairs_shuffled(n):
    """Lines of two words, each line twice, so far apart that no three words come again."""
    lines = [f"left{k:02d} more{k:02d}" for k in range(n)]
    return "\n".join(lines + lines[::2] + lines[1::2])


# Texts that pass the base rules, and all fences but one.
ONLY = {
    "mean_chars_low": " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}"[: 1 + k % 2] for k in range(52)),
    "mean_chars_high": " ".join(f"w{k:059d}" for k in range(60)),
    "symbols_high": " ".join(w[:-1] + "#" if k % 2 else w for k, w in enumerate(prose(11).split())),
    "dup_lines_high": pairs_shuffled(60),
    "repeats_high": " ".join([prose(13, 60), prose(14, 30), prose(15, 30), prose(16, 80), prose(14, 30), prose(17, 5), prose(15, 30)]),
}


def test_each_fence_alone_rejects(spark):
    rows = [(i, "\n".join(prose(i + 3000 * j, 12) for j in range(5)), "en", f"s{i % 2}") for i in range(400)]
    rows += [(1000 + k, t, "en", "s0") for k, t in enumerate(ONLY.values())]
    measures = quality.measured(docs_table(spark, rows).drop("kept", "size"))
    limits = quality.fences(measures)
    one = {r["__source"]: r for r in limits.collect()}["s0"]
    found = {r.doc_id: r for r in measures.filter("doc_id >= 1000").select("*", *(v.alias(f"__{k}") for k, v in quality._ratios().items())).collect()}
    for k, name in enumerate(ONLY):
        r = found[1000 + k]
        fired = set()
        for f in quality.FENCES:
            count, scale, per = quality.RATIOS[f.measure]
            if f.low and r[f"__{f.measure}"] < one[f"{f.measure}_low"]:
                fired.add(f"{f.measure}_low")
            if (r[count] - f.free) * scale >= (one[f"{f.measure}_high"] + 1) * max(r[per], 1):
                fired.add(f"{f.measure}_high")
        assert fired == {name}, (name, fired)
    judged = {r.doc_id: r for r in quality.judge(docs_table(spark, rows)).collect()}
    assert [judged[1000 + k].base_failed for k in range(5)] == [False] * 5
    assert [judged[1000 + k].kept for k in range(5)] == [False] * 5
    assert all(judged[i].kept for i in range(400))


def test_limits_follow_the_source(spark):
    """What is usual in one source is an outlier in another."""
    rows = [(i, prose(i) + " #" * 20, "en", "code") for i in range(400)] + [(500 + i, prose(i), "en", "prose") for i in range(400)]
    rows += [(2000, prose(7) + " #" * 20, "en", "prose")]
    judged = {r.doc_id: r.kept for r in quality.judge(docs_table(spark, rows)).collect()}
    assert judged[3] and not judged[2000]


def test_no_size_is_a_switch(spark):
    """Limits move by steps of rounding as documents are added one by one."""
    base = [(i, prose(i), "en", "large") for i in range(300)]
    highs = []
    for n in (195, 199, 200, 201, 205):
        rows = base + [(1000 + i, prose(i) + " #" * 10, "en", "small") for i in range(n)]
        found = quality.fences(quality.measured(docs_table(spark, rows).drop("kept", "size")))
        highs.append({r["__source"]: r.symbols_high for r in found.collect()}["small"])
    assert max(highs) - min(highs) <= 0.05 * max(highs)


def test_columns_with_clashing_names(spark):
    table = docs_table(spark, rows()[:40])
    odd = table.withColumns({c: table.text for c in ("__lang", "__source", "symbols_high", "n_lines", "measure", "__carried_0", "total")})
    assert quality.kept(odd).columns == odd.columns
    assert quality.kept(odd).count() == quality.kept(table).count()
    assert quality.judge(odd).filter("kept").count() == quality.judge(table).filter("kept").count()
