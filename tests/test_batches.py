"""Facts and metrics after batches against a build from all rows; layout by month."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.operators.quality import dedupe
from orderlens.plans import incremental, metrics, months, state
from orderlens.plans.facts import Options, build_order_facts
from orderlens.sources import read_table

START = datetime(2024, 1, 1)


def rows(df, columns=None):
    columns = sorted(columns or df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def given(spark, seed, n=120):
    """Orders, stock and shipments over four months, with copies, equal times, nulls and lines without stock."""
    pick = random.Random(seed)

    def when(nulls=0.05):
        return None if pick.random() < nulls else START + timedelta(hours=pick.randint(0, 2800) // 6 * 6)

    def one_of(prefix, k, nulls=0.05):
        return None if pick.random() < nulls else f"{prefix}{pick.randint(1, k)}"

    orders = [
        (one_of("O", 40), when(), "C", "online", one_of("R", 2), one_of("S", 6), pick.choice([1, 5, None]),
         pick.choice([10, 20, None]), 0, None, "placed")
        for _ in range(n)
    ]
    stock = [(when(), one_of("W", 3), one_of("R", 2), one_of("S", 5), pick.choice([0, 3, 9, None])) for _ in range(n)]
    shipments = [(one_of("O", 40), "UPS", when(), when(0.4), pick.choice(["DELIVERED", "IN_TRANSIT", None])) for _ in range(40)]
    return (
        spark.createDataFrame(orders, schemas.ORDERS),
        schemas.conform_inventory(spark.createDataFrame(stock, schemas.INVENTORY)),
        schemas.conform_shipments(spark.createDataFrame(shipments, schemas.SHIPMENTS)),
    )


def full(orders, stock, shipments, options):
    return build_order_facts(orders, stock, shipments, options)


CASES = [
    Options(),
    Options(how="left", shipments="all"),
    Options(how="left", keys=("sku", "region"), shipments="none"),
]


@pytest.mark.parametrize("options", CASES, ids=["inner", "left-all", "region"])
def test_batches_in_any_order_equal_one_build(spark, tmp_path, options):
    tables = given(spark, 11)
    store = incremental.Store(str(tmp_path))
    for k in (1, 0, 2):
        part = [df.where(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == k) for df in tables]
        incremental.apply_batch(spark, store, f"b{k}", *part, options)
    want = full(*tables, options)
    assert rows(incremental.facts_now(spark, store), want.columns) == rows(want)
    assert rows(state.totals(incremental.state_now(spark, store))) == rows(metrics.metric_totals(want))
    lines = read_table(spark, store.at("lines"), schema=incremental.LINES_BY_MONTH).drop(months.MONTH)
    assert rows(lines) == rows(dedupe(tables[0], ("order_id", "sku")))


def files(path, month):
    return {p.name: p.stat().st_mtime_ns for p in Path(path).glob(f"order_month={month}/*.parquet")}


def line(order_id, day, sku="A", qty=3):
    return (order_id, START + timedelta(days=day), "C", "online", "R", sku, qty, 10, 0, None, "placed")


def stock_row(day, on_hand, sku="A"):
    return (START + timedelta(days=day), "W", "R", sku, on_hand)


@pytest.fixture
def store(spark, tmp_path):
    """Lines of January to April for two SKUs, each with one old snapshot."""
    orders = spark.createDataFrame([line(f"O{k}", 31 * k, s) for k in range(4) for s in "AB"], schemas.ORDERS)
    stock = spark.createDataFrame([stock_row(-1, 9), stock_row(-1, 9, "B")], schemas.INVENTORY)
    made = incremental.Store(str(tmp_path))
    shipments = schemas.conform_shipments(spark.createDataFrame([], schemas.SHIPMENTS))
    incremental.apply_batch(spark, made, "first", orders, schemas.conform_inventory(stock), shipments)
    return made


def batch(spark, orders=(), stock=(), shipments=()):
    frames = [spark.createDataFrame(list(r), s) for r, s in ((orders, schemas.ORDERS), (stock, schemas.INVENTORY), (shipments, schemas.SHIPMENTS))]
    return frames[0], schemas.conform_inventory(frames[1]), schemas.conform_shipments(frames[2])


def test_a_late_snapshot_changes_lines_up_to_the_next_one(spark, store):
    incremental.apply_batch(spark, store, "next", *batch(spark, stock=[stock_row(70, 8)]))
    before = {m: files(store.at("facts"), m) for m in ("2024-01-01", "2024-02-01", "2024-03-01")}
    incremental.apply_batch(spark, store, "late", *batch(spark, stock=[stock_row(40, 1)]))
    known = {(r.order_id, r.sku): r.inventory_at_order_time for r in incremental.facts_now(spark, store).collect()}
    assert known == {("O0", "A"): 9, ("O1", "A"): 9, ("O2", "A"): 1, ("O3", "A"): 8, **{(f"O{k}", "B"): 9 for k in range(4)}}
    changed = read_table(spark, store.at("changes", "late"), schema=incremental.CHANGES)
    assert rows(changed, ("order_id", "sku", "_sign")) == [(-1, "O2", "A"), (1, "O2", "A")]
    after = {m: files(store.at("facts"), m) for m in before}
    assert after["2024-01-01"] == before["2024-01-01"] and all(before.values())
    assert {m for m in before if after[m] != before[m]} == {rows(changed.select(F.col(months.MONTH).cast("string")))[0][0]}


def test_months_without_a_change_keep_their_files(spark, store):
    tables = ("facts", "lines")
    before = {t: {m: files(store.at(t), m) for m in ("2024-01-01", "2024-02-01", "2024-03-01")} for t in tables}
    incremental.apply_batch(spark, store, "new", *batch(spark, orders=[line("O9", 45)]))
    for t in tables:
        after = {m: files(store.at(t), m) for m in before[t]}
        assert {m for m in after if after[m] == before[t][m]} == {"2024-01-01", "2024-03-01"}
    shipped = [("O0", "UPS", START, None, "IN_TRANSIT")]
    lines = files(store.at("lines"), "2024-01-01")
    incremental.apply_batch(spark, store, "shipped", *batch(spark, shipments=shipped))
    assert files(store.at("lines"), "2024-01-01") == lines
    assert files(store.at("facts"), "2024-01-01") != before["facts"]["2024-01-01"]


def test_a_copy_that_wins_takes_its_line_to_another_month(spark, store):
    assert files(store.at("facts"), "2024-03-01")
    earlier = [line("O2", 1, s) for s in "AB"]
    incremental.apply_batch(spark, store, "copies", *batch(spark, orders=earlier))
    assert not files(store.at("facts"), "2024-03-01") and not files(store.at("lines"), "2024-03-01")
    found = {r.order_id: str(r.order_month) for r in incremental.facts_now(spark, store).collect()}
    assert found["O2"] == "2024-01-01" and len(found) == 4


@pytest.mark.parametrize("step", ["parts", "facts", "lines"])
def test_a_stopped_run_is_repeated(spark, store, monkeypatch, step):
    news = batch(spark, [line("O1", 35, "A", 99), line("O5", 64)], [stock_row(61, 2)], [("O0", "UPS", START, START, "DELIVERED")])
    replace, put = incremental._replace, incremental.write_table

    def stop_replace(spark, store, batch_id, name, *rest):
        if name == step:
            raise RuntimeError("lost")
        replace(spark, store, batch_id, name, *rest)

    def stop_write(df, path, *rest):
        if step == "parts" and "/parts/" in path:
            raise RuntimeError("lost")
        put(df, path, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "_replace", stop_replace)
        patch.setattr(incremental, "write_table", stop_write)
        with pytest.raises(RuntimeError):
            incremental.apply_batch(spark, store, "news", *news)
    for _ in range(2):
        incremental.apply_batch(spark, store, "news", *news)
        facts = incremental.facts_now(spark, store)
        assert facts.count() == 9
        got = {(r.order_id, r.sku): (r.quantity, r.inventory_at_order_time, r.delivery_status) for r in facts.collect()}
        assert got[("O5", "A")] == (3, 2, None) and got[("O0", "A")] == (3, 9, "DELIVERED")
        assert rows(state.totals(incremental.state_now(spark, store))) == rows(metrics.metric_totals(facts))


def test_reports_come_from_the_parts(spark, store, tmp_path):
    gold = str(tmp_path / "gold")
    incremental.write_current_metrics(spark, store, gold)
    got = read_table(spark, f"{gold}/revenue_kpis/by_sku").drop("metric_generated_ts")
    assert rows(got) == rows(metrics.revenue(incremental.facts_now(spark, store), "sku"))
    folded = incremental.fold_parts(spark, store, str(tmp_path / "folded"))
    assert rows(folded) == rows(incremental.state_now(spark, store))


def test_an_empty_batch_changes_nothing(spark, store):
    before = rows(incremental.facts_now(spark, store))
    incremental.apply_batch(spark, store, "empty", *batch(spark))
    assert rows(incremental.facts_now(spark, store)) == before


def test_a_month_is_one_folder_of_the_scan(spark, store):
    facts = incremental.facts_now(spark, store)
    one = months.read_months(spark, store.at("facts"), START.date(), START.date())
    assert len(one.collect()) == 2
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    read = scan.metrics().apply("numFiles").value()
    assert read == len(files(store.at("facts"), "2024-01-01")) < len(facts.inputFiles())
    latest = months.of_months(facts, months.last_months(facts))
    assert rows(latest, ("order_id",)) == [("O3",)] * 2
    latest.collect()
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_the_work_of_an_applied_batch_goes(spark, store):
    from orderlens.sources.files import exists, folders

    news = batch(spark, [line("O7", 40)])
    incremental.apply_batch(spark, store, "news", *news)
    assert not folders(spark, store.at("aside")) and exists(spark, store.at("changes", "news"))
    before = rows(incremental.facts_now(spark, store))
    incremental.apply_batch(spark, store, "news", *news)
    assert rows(incremental.facts_now(spark, store)) == before and not folders(spark, store.at("aside"))


@pytest.mark.parametrize("moved", [0, 1, 2, 3])
def test_a_run_that_stopped_amid_the_moves_goes_on(spark, store, monkeypatch, moved):
    """Months move in folder by folder; whatever of them is in when a run stops, the next one ends with the same rows."""
    news = batch(spark, [line("O0", 1, "A", 7), line("O1", 30, "A", 99), line("O9", 64)])
    move, done = incremental.move, []

    def stop(spark, path, target):
        if len(done) == moved:
            raise RuntimeError("lost")
        done.append(move(spark, path, target))

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "move", stop)
        with pytest.raises(RuntimeError):
            incremental.apply_batch(spark, store, "news", *news)
    incremental.apply_batch(spark, store, "news", *news)
    facts = incremental.facts_now(spark, store)
    got = {(r.order_id, r.sku): r.quantity for r in facts.collect()}
    assert got[("O1", "A")] == 99 and ("O9", "A") in got and len(got) == facts.count() == 9
    assert rows(state.totals(incremental.state_now(spark, store))) == rows(metrics.metric_totals(facts))


def test_a_month_is_dealt_once_and_the_match_reads_written_rows(spark, store, monkeypatch):
    dealt, aside = [], []
    by_month, write = incremental.write_by_month, incremental.write_table

    def count_dealt(df, path, **more):
        dealt.append(path.rsplit("/", 1)[1])
        by_month(df, path, **more)

    def count_aside(df, path, *more):
        aside.append(path.rsplit("/", 1)[1])
        write(df, path, *more)

    monkeypatch.setattr(incremental, "write_by_month", count_dealt)
    monkeypatch.setattr(incremental, "write_table", count_aside)
    incremental.apply_batch(spark, store, "news", *batch(spark, [line("O8", 40)], [stock_row(41, 2)]))
    assert dealt == ["facts", "lines"] and {"asking", "answers"} <= set(aside)


def test_what_a_compaction_replaced_goes(spark, tmp_path):
    from orderlens.plans import pipeline
    from orderlens.sources import land_batch
    from orderlens.sources.files import folders

    areas = {name: str(tmp_path / "landing" / name) for name in ("orders", "inventory", "shipments")}
    paths = pipeline.Paths(**areas, silver=str(tmp_path / "silver"), gold=str(tmp_path / "gold"))
    for k in range(2):
        orders, stock, shipments = given(spark, k)
        land_batch(orders, paths.orders, f"b{k}")
        land_batch(stock.withColumnRenamed("inventory_region", "region"), paths.inventory, f"b{k}")
        land_batch(shipments.withColumnRenamed("delivery_status", "status"), paths.shipments, f"b{k}")
        pipeline.run_changes(spark, paths)
        pipeline.compact_ingested(spark, paths)
    before = rows(incremental.facts_now(spark, paths.store))
    gone = pipeline.vacuum_ingested(spark, paths)
    assert sorted(gone) == sorted(areas) and all(gone.values())
    for name in areas:
        table = f"{paths.silver}/conformed/{name}_appended"
        assert [f for f in folders(spark, table) if not f.startswith("_")] == [pipeline.pointer(spark, f"{table}/_folders.json")["added"][0]]
    pipeline.run_changes(spark, paths)
    assert rows(incremental.facts_now(spark, paths.store)) == before
