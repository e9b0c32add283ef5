"""Landing, tables, sinks and the incremental conversion, on files."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.operators import order_ids, orders_without_shipment, shipments_for
from orderlens.plans.facts import Options
from orderlens.plans.pipeline import Paths, ingest, run_pipeline
from orderlens.sources import (
    bad_records,
    good_records,
    jdbc_options,
    land_batch,
    load_metrics,
    read_landing_json,
    read_table,
    shared_dir,
    write_metrics,
    write_table,
)
from orderlens.streaming import convert_new_batches


def order(order_id="O1", sku="A", **other):
    record = dict(
        order_id=order_id, order_ts="2024-01-10T09:00:00.123456", customer_id="C1", channel="online",
        region="West", sku=sku, qty=3, unit_price=10, discount=0,
        promised_delivery_ts="2024-01-13T09:00:00", order_status="placed",
    )
    return record | other


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content)
    (folder / name).write_text(text)


@pytest.mark.parametrize("multi_line", [False, True])
def test_array_object_and_unreadable_files(spark, tmp_path, multi_line):
    put(tmp_path, "a.json", [order("O1"), order("O2")])
    put(tmp_path, "b.json", order("O3"))
    put(tmp_path, "c.json", '[{"order_id": "O4", ')
    put(tmp_path, "notes.txt", "not landed data")
    landed = read_landing_json(spark, str(tmp_path), schemas.ORDERS, multi_line)
    assert sorted(r.order_id for r in good_records(landed).collect()) == ["O1", "O2", "O3"]
    bad = bad_records(landed).collect()
    assert len(bad) == 1 and bad[0]._source_file.endswith("c.json") and "O4" in bad[0]._corrupt_record
    glob = read_landing_json(spark, f"{tmp_path}/b*.json", schemas.ORDERS)
    assert good_records(glob).count() == 1


def test_documents_over_many_lines(spark, tmp_path):
    put(tmp_path, "a.json", json.dumps([order("O1"), order("O2", qty=None)], indent=1))
    put(tmp_path, "b.json", json.dumps(order("O3"), indent=1) + "\n")
    put(tmp_path, "two.json", json.dumps(order("O4")) + "\n" + json.dumps(order("O5")))
    put(tmp_path, "list.json", json.dumps(order("O6")) + "," + json.dumps(order("O7")))
    put(tmp_path, "empty.json", " ")
    put(tmp_path, "none.json", "[]")
    landed = read_landing_json(spark, str(tmp_path), schemas.ORDERS, multi_line=True)
    good = {r.order_id: r.qty for r in good_records(landed).where("order_id IS NOT NULL").collect()}
    assert good == {"O1": "3", "O2": None, "O3": "3"}
    bad = sorted(r._source_file.rsplit("/", 1)[1] for r in bad_records(landed).collect())
    assert bad == ["empty.json", "list.json", "two.json"]


def test_every_landed_row_reaches_the_pipeline(spark, tmp_path):
    """Batches of one object per line, as the engine itself lands them, read by the defaults."""
    when = datetime(2024, 1, 10, 9)
    orders = spark.range(1000).select(
        F.concat(F.lit("O"), "id").alias("order_id"), F.lit(when).alias("order_ts"), F.lit("A").alias("sku"),
        F.lit(1).alias("qty"), F.lit(2).alias("unit_price"),
    )
    land_batch(orders.coalesce(1), str(tmp_path / "orders"), "b1")
    stock = spark.createDataFrame([(when, "W1", "East", "A", 2)], schemas.INVENTORY)
    land_batch(stock, str(tmp_path / "inventory"), "b1")
    land_batch(spark.createDataFrame([], schemas.SHIPMENTS), str(tmp_path / "logistics"), "b1")
    paths = Paths(
        orders=str(tmp_path / "orders"), inventory=str(tmp_path / "inventory"), shipments=str(tmp_path / "logistics"),
        silver=str(tmp_path / "silver"), gold=str(tmp_path / "gold"),
    )
    written = run_pipeline(spark, paths, Options())
    assert read_table(spark, written["order_facts"]).count() == 1000
    assert read_table(spark, f"{paths.silver}/conformed/orders_rejected").count() == 0
    conformed = read_table(spark, f"{paths.silver}/conformed/orders_landed")
    assert conformed.schema["order_ts"].dataType == schemas.ORDERS["order_ts"].dataType


def test_times_land_as_they_read_on_the_clock(spark, tmp_path):
    """02:30 does not exist in New York on that day, but a zone-less time may well say so."""
    times = [datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30, 0, 7), datetime(999, 1, 1), None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(times)], "order_id string, ship_ts timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        land_batch(df, str(tmp_path), "b1")
        landed = good_records(read_landing_json(spark, str(tmp_path), schemas.SHIPMENTS))
        back = {r.order_id: r.ship_ts for r in schemas.conform_shipments(landed).collect()}
        assert back == {str(i): t for i, t in enumerate(times)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_replaced_batch_counts_once(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")

    def taken_in():
        return {(r.order_id, r.carrier) for r in ingest(spark, landing, schemas.SHIPMENTS, table, False, True).collect()}

    def batch(*rows):
        return spark.createDataFrame(rows, "order_id string, carrier string")

    land_batch(batch(("O1", "wrong"), ("O2", "UPS")), landing, "b1")
    land_batch(batch(("O3", "UPS")), landing, "b2")
    assert taken_in() == {("O1", "wrong"), ("O2", "UPS"), ("O3", "UPS")}
    land_batch(batch(("O1", "FedEx")), landing, "b1")
    assert taken_in() == {("O1", "FedEx"), ("O3", "UPS")}
    assert taken_in() == {("O1", "FedEx"), ("O3", "UPS")}


def test_values_that_do_not_parse_become_null_and_spare_the_rest(spark, tmp_path):
    put(tmp_path, "a.json", [order("O1", qty="many"), order("O2", order_ts="yesterday"), order("O3")])
    landed = good_records(read_landing_json(spark, str(tmp_path), schemas.ORDERS))
    got = {r.order_id: (r.qty, r.order_ts) for r in schemas.conform_orders(landed).collect()}
    at = datetime(2024, 1, 10, 9, 0, 0, 123456)
    assert got == {"O1": (None, at), "O2": (3, None), "O3": (3, at)}


def test_both_time_forms(spark, tmp_path):
    put(
        tmp_path, "a.json",
        [
            dict(snapshot_ts=text, warehouse_id="W1", region="West", sku="A", on_hand_qty=None)
            for text in ("2024-01-10 09:00:00", "2024-01-10T09:00:00", "2024-01-10 09:00:00.000000")
        ],
    )
    landed = good_records(read_landing_json(spark, str(tmp_path), schemas.INVENTORY))
    rows = schemas.conform_inventory(landed).distinct().collect()
    assert [tuple(r) for r in rows] == [(datetime(2024, 1, 10, 9), "W1", "West", "A", None)]


def test_batches_stand_side_by_side_and_replay_replaces(spark, tmp_path):
    when = datetime(2024, 1, 10, 9, 0, 0, 5)
    df = spark.createDataFrame([("O1", when), ("O2", None)], "order_id string, ship_ts timestamp_ntz")
    path = str(tmp_path / "landing")
    land_batch(df, path, "b1")
    land_batch(df, path, "b1")
    land_batch(df.where("order_id = 'O1'"), path, "b2")
    text = [json.loads(x) for f in (tmp_path / "landing/batch_id=b2").glob("*.json") for x in f.read_text().splitlines()]
    assert text == [{"order_id": "O1", "ship_ts": "2024-01-10T09:00:00.000005"}]
    landed = read_landing_json(spark, path, schemas.SHIPMENTS)
    assert sorted(r.order_id for r in landed.collect()) == ["O1", "O1", "O2"]
    back = schemas.conform_shipments(good_records(landed)).where("order_id = 'O1'").collect()
    assert {r.ship_ts for r in back} == {when}
    land_batch(df, str(tmp_path / "p"), "b1", fmt="parquet")
    assert read_table(spark, str(tmp_path / "p")).count() == 2
    with pytest.raises(ValueError, match="format"):
        land_batch(df, path, "b1", fmt="csv")


def test_table_round_trip_keeps_null_columns(spark, tmp_path):
    row = ("O1", "A", "C", 1, 2, 2, None, None, "W1", None, None, None, None, None, None)
    df = spark.createDataFrame([row], schemas.ORDER_FACTS)
    parquet, text = str(tmp_path / "p"), str(tmp_path / "j")
    write_table(df, parquet)
    df.write.json(text)
    for back in (read_table(spark, parquet), read_table(spark, text, "json", schemas.ORDER_FACTS)):
        assert back.schema.names == df.schema.names
        assert [tuple(r) for r in back.collect()] == [row]
    write_table(df, parquet, partition_by=["sku"])
    assert read_table(spark, parquet).where("sku = 'A'").count() == 1
    with pytest.raises(ValueError):
        read_table(spark, text, "json")
    with pytest.raises(ValueError):
        read_table(spark, text, "avro")


def test_metrics_written_and_loaded(spark, tmp_path):
    base = str(tmp_path)
    write_metrics({"kpis/summary": spark.range(3), "kpis/by_sku": spark.range(5)}, base)
    assert load_metrics(spark, base, "kpis/summary").count() == 3
    assert load_metrics(spark, base, "kpis/by_sku").count() == 5
    with pytest.raises(AnalysisException):
        load_metrics(spark, base, "kpis/missing")


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "inventory_snapshots", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "inventory_snapshots", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x", "t", "snapshot_ts", ("2024-01-01", "2024-02-01"), 16)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "snapshot_ts", "2024-01-01", "2024-02-01", "16"
    )
    with pytest.raises(ValueError, match="bounds"):
        jdbc_options("jdbc:x", "t", "snapshot_ts")


def test_keyed_lookup(spark):
    orders = spark.createDataFrame([("O1", "A"), ("O1", "B"), ("O2", "A")], "order_id string, sku string")
    shipments = spark.createDataFrame([("O1", "UPS"), ("O1", "USPS"), ("O9", "UPS")], "order_id string, carrier string")
    assert sorted(r.carrier for r in shipments_for(orders, shipments).collect()) == ["UPS", "USPS"]
    assert [r.order_id for r in orders_without_shipment(orders, shipments).collect()] == ["O2"]
    assert order_ids(orders).count() == 2


def test_shared_folder_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_incremental_conversion_takes_each_file_once(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")

    def run():
        convert_new_batches(
            spark, str(landing), schemas.ORDERS, table, str(tmp_path / "state")
        ).awaitTermination()
        return sorted(r.order_id for r in good_records(read_table(spark, table)).collect())

    put(landing, "a.json", [order("O1"), order("O2")])
    assert run() == ["O1", "O2"]
    assert run() == ["O1", "O2"]
    put(landing, "b.json", order("O3"))
    put(landing, "c.json", "{broken")
    assert run() == ["O1", "O2", "O3"]
    rejected = bad_records(read_table(spark, table)).collect()
    assert [r._source_file.rsplit("/", 1)[1] for r in rejected] == ["c.json"]


@pytest.mark.parametrize("incremental", [False, True])
def test_pipeline_from_landing_to_gold(spark, tmp_path, incremental):
    put(tmp_path / "orders", "a.json", [order("O1"), order("O2", "B", qty=1)])
    put(tmp_path / "orders", "b.json", [order("O1", qty=9)])
    put(tmp_path / "orders", "c.json", "[broken")
    put(
        tmp_path / "inventory", "a.json",
        [
            dict(snapshot_ts="2024-01-10 08:00:00", warehouse_id="W1", region="East", sku=s, on_hand_qty=2)
            for s in ("A", "B")
        ],
    )
    for i, status in enumerate(("IN_TRANSIT", "DELIVERED")):
        put(
            tmp_path / "logistics", f"{i}.json",
            dict(order_id="O1", carrier="UPS", ship_ts=f"2024-01-10T1{i}:00:00", delivered_ts=None, status=status),
        )
    paths = Paths(
        orders=str(tmp_path / "orders"), inventory=str(tmp_path / "inventory"),
        shipments=str(tmp_path / "logistics"), silver=str(tmp_path / "silver"), gold=str(tmp_path / "gold"),
        incremental=incremental,
    )
    for _ in range(2):  # a rerun replaces every table
        written = run_pipeline(spark, paths, Options())
    facts = read_table(spark, written["order_facts"])
    assert [f.name for f in facts.schema.fields] == schemas.ORDER_FACTS.names
    assert sorted((r.order_id, r.sku, r.quantity, r.stockout_flag, r.delivery_status) for r in facts.collect()) == [
        ("O1", "A", 3, True, "DELIVERED"),
        ("O2", "B", 1, False, None),
    ]
    gold = {n for n in written if "/" in n}
    assert gold == {
        "revenue_kpis/summary", "revenue_kpis/by_region", "revenue_kpis/by_sku", "revenue_at_risk/summary",
        "revenue_at_risk/by_region", "revenue_at_risk/by_sku", "supply_chain_metrics/summary",
    }
    for name in gold:
        assert "metric_generated_ts" in load_metrics(spark, paths.gold, name).columns
    summary = load_metrics(spark, paths.gold, "revenue_kpis/summary").collect()[0]
    assert (summary.total_revenue, summary.total_orders, summary.avg_order_value) == (40, 2, 20.0)
    supply = load_metrics(spark, paths.gold, "supply_chain_metrics/summary").collect()[0]
    assert (supply.stockout_rate, supply.delivery_success_rate) == (0.5, 0.5)
    rejected = read_table(spark, f"{paths.silver}/conformed/orders_rejected").collect()
    assert len(rejected) == 1 and rejected[0]._source_file.endswith("c.json")
    assert read_table(spark, written["order_lines"]).agg(F.count("promised_delivery_ts")).collect()[0][0] == 2

    put(tmp_path / "orders", "d.json", order("O3", "B", unit_price=100))
    run_pipeline(spark, paths, Options())
    assert load_metrics(spark, paths.gold, "revenue_kpis/summary").collect()[0].total_revenue == 340


def test_own_folder_where_none_is_named():
    from types import SimpleNamespace

    def bare(master, folder=None):
        context = SimpleNamespace(applicationId="none-named", master=master, getCheckpointDir=lambda: folder)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    assert shared_dir(bare("local[8]")) == shared_dir(bare("local[*]")) == shared_dir(bare("local")) != ""
    assert shared_dir(bare("spark://host:7077", "hdfs://shared/x/")) == "hdfs://shared/x"
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="share"):
            shared_dir(bare(master))


def carriers(spark, landing):
    return sorted(r.carrier for r in good_records(read_landing_json(spark, landing, schemas.SHIPMENTS)).collect())


@pytest.mark.parametrize("step", ["aside", "moved", "flipped"])
def test_replacing_a_batch_leaves_no_gap(spark, tmp_path, monkeypatch, step):
    """A run that stops anywhere leaves the old batch or the new one, whole, and the next run replaces it."""
    from orderlens.sources import files

    landing = str(tmp_path / "landing")

    def batch(carrier, n):
        return spark.createDataFrame([(f"O{k}", carrier) for k in range(n)], "order_id string, carrier string").repartition(3)

    land_batch(batch("old", 5), landing, "b1")
    land_batch(batch("other", 1), landing, "b2")
    put, move, remove, flips = files.put_pointer, files.move, files.remove, []

    def stop_move(*args):
        raise RuntimeError("lost")

    def stop_put(spark, path, value):
        flips.append(path)
        if len(flips) == 2:
            raise RuntimeError("lost")
        put(spark, path, value)

    with monkeypatch.context() as patch:
        if step == "aside":
            patch.setattr(files, "move", stop_move)
        elif step == "moved":
            patch.setattr(files, "put_pointer", stop_put)
        else:
            patch.setattr(files, "remove", stop_move)
        with pytest.raises(RuntimeError):
            land_batch(batch("new", 4), landing, "b1")
    assert (files.put_pointer, files.move, files.remove) == (put, move, remove)
    old_or_new = ["old"] * 5 if step != "flipped" else ["new"] * 4
    assert carriers(spark, landing) == sorted(old_or_new + ["other"])
    for k in range(3):
        land_batch(batch(f"again{k}", 2), landing, "b1")
        assert carriers(spark, landing) == sorted([f"again{k}"] * 2 + ["other"])
        left = {p.name for p in (tmp_path / "landing/batch_id=b1").glob("*.json") if p.name[0] != "_"}
        assert len(left) <= 6


def test_a_reader_of_a_replaced_batch_goes_on(spark, tmp_path):
    landing = str(tmp_path)
    land_batch(spark.createDataFrame([("O1", "old")], "order_id string, carrier string"), landing, "b1")
    running = read_landing_json(spark, landing, schemas.SHIPMENTS)
    land_batch(spark.createDataFrame([("O1", "new")], "order_id string, carrier string"), landing, "b1")
    assert [r.carrier for r in running.collect()] == ["old"]
    assert carriers(spark, landing) == ["new"] == carriers(spark, f"{tmp_path}/batch_id=*")


def test_a_missing_library_takes_no_other_query(monkeypatch):
    """What the training-data part needs may be missing; the other queries stay, and a warning says why."""
    import __spark_entry__ as entry

    def missing(name, *rest):
        raise ModuleNotFoundError("No module named 'ahocorasick'", name="ahocorasick")

    monkeypatch.setattr(entry.importlib, "import_module", missing)
    with pytest.warns(UserWarning, match="ahocorasick"):
        assert entry.queries().keys() == entry.core_queries().keys()
    with pytest.warns(UserWarning):
        assert entry.oracle_sql().keys() == entry.core_oracle_sql().keys()


def test_a_packed_batch_lands_like_a_plain_one(spark, tmp_path, monkeypatch):
    """Packed files are smaller, cut at a number of records, and taken in by scans and streams beside plain ones."""
    from orderlens.sources import sinks

    monkeypatch.setattr(sinks, "RECORDS_A_FILE", 400)
    df = spark.range(0, 1000, 1, 1).selectExpr("concat('O', id) AS order_id", "'UPS' AS carrier")
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    land_batch(df, plain, "b1")
    for _ in range(2):
        land_batch(df, packed, "b1", compression="gzip")
    sizes = {at: [f.stat().st_size for f in (tmp_path / at / "batch_id=b1").glob("part-*")] for at in ("plain", "packed")}
    assert len(sizes["packed"]) == 6 and sum(sizes["packed"]) < sum(sizes["plain"])
    assert carriers(spark, packed) == carriers(spark, plain) == ["UPS"] * 1000
    land_batch(df.limit(1), packed, "b2")
    taken = ingest(spark, packed, schemas.SHIPMENTS, str(tmp_path / "table"), False, True)
    assert taken.count() == 1001
    with pytest.raises(ValueError, match="compression"):
        land_batch(df, packed, "b3", compression="zip")


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    from pathlib import Path

    local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before = set(local.rglob("shuffle_*.data"))
    write_table(spark.range(0, 100_000, 1, 4).selectExpr("id % 50000 AS k").groupBy("k").count(), str(tmp_path / "t"))
    assert set(local.rglob("shuffle_*.data")) <= before
