"""Load folders of the incremental tables: compaction, readers that run meanwhile, copies left out of a stream."""

from __future__ import annotations

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.plans.pipeline import ingest
from orderlens.sources import bad_records, files, good_records, land_batch, landed_schema
from orderlens.streaming import Once, compact, convert_new_batches, present_files, read_converted, read_loads, vacuum
from orderlens.streaming.loads import live_folders

SHIPPED = landed_schema(schemas.SHIPMENTS)


class Area:
    """A landing area and the table that is made from it."""

    def __init__(self, spark, base):
        self.spark, self.landing, self.base = spark, str(base / "landing"), str(base / "table")
        self.table = f"{self.base}_appended"

    def land(self, batch_id, *rows):
        land_batch(self.spark.createDataFrame(rows, "order_id string, carrier string"), self.landing, batch_id)

    def ingested(self):
        return ingest(self.spark, self.landing, schemas.SHIPMENTS, self.base, False, True)

    def rows(self):
        return sorted((r.order_id, r.carrier) for r in self.ingested().collect())

    def stored(self):
        """What the data files hold, whoever reads them."""
        folders = [f"{self.table}/{f}" for f in files.folders(self.spark, self.table)]
        return sorted((r.order_id, r.carrier) for f in folders for r in self.spark.read.parquet(f).collect())


@pytest.fixture
def area(spark, tmp_path):
    made = Area(spark, tmp_path)
    for k in range(3):
        made.land(f"b{k}", (f"O{k}", "UPS"), (f"P{k}", "UPS"))
        made.ingested()
    made.land("b1", ("O1", "DHL"))
    assert made.rows() == [("O0", "UPS"), ("O1", "DHL"), ("O2", "UPS"), ("P0", "UPS"), ("P2", "UPS")]
    return made


def test_dead_rows_go_and_small_loads_become_one_file(spark, area):
    before = area.rows()
    assert len(area.stored()) == 7 and len(live_folders(spark, area.table)) == 4
    made = compact(spark, area.table, SHIPPED, area.landing)
    assert live_folders(spark, area.table) == [made]
    assert len(files.data_files(spark, f"{area.table}/{made}")) == 1
    assert area.rows() == before and len(area.stored()) == 12
    assert len(vacuum(spark, area.table)) == 4
    assert area.rows() == before == area.stored()
    assert compact(spark, area.table, SHIPPED, area.landing) is None


def test_a_reader_goes_on_during_a_compaction(spark, area):
    running = present_files(read_converted(spark, area.table, schemas.SHIPMENTS), area.landing)
    compact(spark, area.table, SHIPPED, area.landing)
    area.land("b3", ("O3", "UPS"))
    assert len(area.rows()) == 6
    assert sorted(r.order_id for r in running.collect()) == ["O0", "O1", "O2", "P0", "P2"]


def test_loads_after_a_compaction_and_another_one(spark, area):
    first = compact(spark, area.table, SHIPPED, area.landing)
    area.land("b2", ("O2", "DHL"))
    area.land("b4", ("O4", "UPS"))
    want = [("O0", "UPS"), ("O1", "DHL"), ("O2", "DHL"), ("O4", "UPS"), ("P0", "UPS")]
    assert area.rows() == want
    second = compact(spark, area.table, SHIPPED, area.landing)
    assert live_folders(spark, area.table) == [second] != [first]
    vacuum(spark, area.table)
    assert area.rows() == want == area.stored()


def test_a_replaced_load_that_is_written_again_stays_out(spark, area):
    """As a stream does that stopped before it noted the load as done."""
    again = spark.read.schema(SHIPPED).parquet(f"{area.table}/load=000000000")
    kept = [tuple(r) for r in again.collect()]
    compact(spark, area.table, SHIPPED, area.landing)
    vacuum(spark, area.table)
    before = area.rows()
    spark.createDataFrame(kept, SHIPPED).write.parquet(f"{area.table}/load=000000000")
    assert area.rows() == before


def test_unfinished_work_is_not_read(spark, area, monkeypatch):
    before = area.rows()
    from orderlens.streaming import loads

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(loads, "put_pointer", lost)
        with pytest.raises(RuntimeError):
            compact(spark, area.table, SHIPPED, area.landing)
    Path(area.table, "load=000000077").mkdir()
    assert area.rows() == before
    assert [f for f in vacuum(spark, area.table)][0].startswith("compacted-")
    assert area.rows() == before


def test_full_folders_are_not_touched(spark, area):
    made = compact(spark, area.table, SHIPPED, area.landing)
    area.land("b9", ("O9", "UPS"))
    area.ingested()
    size = sum(files.data_files(spark, f"{area.table}/{made}").values())
    compact(spark, area.table, SHIPPED, area.landing, target_bytes=size)
    assert made in live_folders(spark, area.table)


def test_no_file_is_made_of_more_records_than_asked(spark, area):
    """Small in Parquet or not: one task reads all rows of a file."""
    area.land("b9", *[(f"Q{k}", "UPS") for k in range(1000)])
    before = area.rows()
    made = compact(spark, area.table, SHIPPED, area.landing, target_records=600)
    assert live_folders(spark, area.table) == [made]
    rows = spark.read.parquet(f"{area.table}/{made}").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in rows) == len(before) == 1005
    assert len(rows) == 2 and max(r["count"] for r in rows) <= 600
    assert area.rows() == before
    # What is full by its records is neither small nor scattered; dead records in it still go.
    assert compact(spark, area.table, SHIPPED, area.landing, target_records=600) is None
    area.land("b9", ("Q0", "DHL"))
    before = area.rows()
    assert compact(spark, area.table, SHIPPED, area.landing, target_records=600) is not None
    vacuum(spark, area.table)
    assert len(before) == 6 and area.stored() == area.rows() == before


def test_pointer_is_replaced_in_one_step(spark, tmp_path):
    path = str(tmp_path / "p.json")
    assert files.pointer(spark, path, 7) == 7
    for value in ({"a": [1]}, {"b": "ü"}):
        files.put_pointer(spark, path, value)
        assert files.pointer(spark, path) == value
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["p.json"]


def order(order_id, sku="A", **other):
    return {"order_id": order_id, "sku": sku, "order_ts": "2024-01-10T09:00:00", "qty": 1} | other


def test_copies_in_a_stream(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    landing.mkdir()

    def run(delay="1 hour"):
        query = convert_new_batches(
            spark, str(landing), schemas.ORDERS, table, str(tmp_path / "state"), once=Once(("order_id", "sku"), delay)
        )
        query.awaitTermination()
        return query

    def put(name, *records):
        (landing / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))

    put("a.json", order("O1"), order("O1"), order("O1", "B"), order(None), order(None), "{broken", "{broken")
    run()
    put("b.json", order("O1", order_ts="1999-01-01T00:00:00"), order("O2"))
    run()
    put("c.json", order("O2"), order("O3"), order(None), "{broken")
    run()
    found = read_converted(spark, table, schemas.ORDERS)
    keys = sorted((r.order_id or "", r.sku) for r in good_records(found).collect())
    assert keys == [("", "A")] * 3 + [("O1", "A"), ("O1", "B"), ("O2", "A"), ("O3", "A")]
    assert bad_records(found).count() == 3


def test_the_state_of_a_stream_is_bounded(spark, tmp_path):
    landing, held = tmp_path / "landing", []
    landing.mkdir()
    for k in range(4):
        lines = [json.dumps(order(f"O{k}-{n}")) for n in range(50)]
        (landing / f"{k}.json").write_text("\n".join(lines))
        query = convert_new_batches(
            spark, str(landing), schemas.ORDERS, str(tmp_path / "t"), str(tmp_path / "s"), once=Once(("order_id", "sku"), "1 second")
        )
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1.2)
    assert max(held) <= 100
    assert read_converted(spark, str(tmp_path / "t"), schemas.ORDERS).count() == 200


def test_the_keys_of_a_stream_lie_on_disk(spark, tmp_path):
    """A stream that knows its keys holds them on the executors' disks; the session's own settings come back."""
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text(json.dumps(order("O1")))
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    convert_new_batches(
        spark, str(tmp_path / "landing"), schemas.ORDERS, str(tmp_path / "t"), str(tmp_path / "s"), once=Once(("order_id", "sku"), "1 day")
    ).awaitTermination()
    assert "RocksDBStateStoreProvider" in (tmp_path / "s" / "offsets" / "0").read_text()
    assert spark.conf.get(name) == before and "RocksDB" not in before
