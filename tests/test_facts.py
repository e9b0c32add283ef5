"""Facts: options, determinism and invariants."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlens import schemas
from orderlens.operators import attach_shipments, dedupe, latest_shipments
from orderlens.plans.facts import Options, build_order_facts, line_facts, match_inventory, order_lines, stock_by
from orderlens.sources import read_table, write_table

T0 = datetime(2024, 1, 10, 9)
MEDIUM = "/root/testdata/sf0.01"

ORDER = ("O1", T0, "C1", "online", "West", "A", 3, 10, 0, T0 + timedelta(days=3), "placed")
STOCK = (T0 - timedelta(hours=1), "W1", "East", "A", 2)
SHIPMENT = ("O1", "UPS", T0, T0 + timedelta(hours=5), "DELIVERED")


def frames(spark, orders=(ORDER,), stock=(STOCK,), shipments=(SHIPMENT,)):
    return (
        schemas.conform_orders(spark.createDataFrame(list(orders), schemas.ORDERS)),
        schemas.conform_inventory(spark.createDataFrame(list(stock), schemas.INVENTORY)),
        schemas.conform_shipments(spark.createDataFrame(list(shipments), schemas.SHIPMENTS)),
    )


def test_one_line(spark):
    row = build_order_facts(*frames(spark)).collect()
    assert [r.asDict() for r in row] == [
        dict(
            order_id="O1", sku="A", customer_id="C1", quantity=3, price=10, order_value=30,
            inventory_at_order_time=2, stockout_flag=True, warehouse_id="W1", region="West",
            delivery_status="DELIVERED", carrier="UPS", ship_ts=T0, delivered_ts=T0 + timedelta(hours=5),
        )
    ]


def test_schema_is_the_declared_one(spark):
    want = [(f.name, f.dataType) for f in schemas.ORDER_FACTS.fields if f.name != "ingestion_ts"]
    got = build_order_facts(*frames(spark)).schema.fields
    assert [(f.name, f.dataType) for f in got] == want


def test_second_shipment(spark):
    later = ("O1", "FedEx", T0 + timedelta(hours=2), None, "IN_TRANSIT")
    inputs = frames(spark, shipments=(SHIPMENT, later))
    assert [r.carrier for r in build_order_facts(*inputs).collect()] == ["FedEx"]
    everything = build_order_facts(*inputs, Options(shipments="all")).collect()
    assert sorted(r.carrier for r in everything) == ["FedEx", "UPS"]
    with pytest.raises(ValueError, match="policy"):
        build_order_facts(*inputs, Options(shipments="some"))


def test_unknown_stock_and_null_order_id(spark):
    nameless = (None, *ORDER[1:])
    unknown = (*STOCK[:4], None)
    rows = build_order_facts(*frames(spark, orders=(ORDER, nameless), stock=(unknown,))).collect()
    assert sorted(((r.order_id, r.stockout_flag, r.carrier) for r in rows), key=str) == [
        ("O1", None, "UPS"),
        (None, None, None),
    ]


def test_left_keeps_lines_without_stock(spark):
    other = ("O2", *ORDER[1:5], "B", *ORDER[6:])
    inputs = frames(spark, orders=(ORDER, other))
    assert build_order_facts(*inputs).count() == 1
    kept = {r.sku: r.warehouse_id for r in build_order_facts(*inputs, Options(how="left")).collect()}
    assert kept == {"A": "W1", "B": None}


def test_region_as_a_match_key(spark):
    west = (STOCK[0] - timedelta(hours=5), "W9", "West", "A", 50)
    inputs = frames(spark, stock=(STOCK, west))
    rows = build_order_facts(*inputs, Options(keys=("sku", "region"))).collect()
    assert [(r.warehouse_id, r.stockout_flag) for r in rows] == [("W9", False)]


def test_copies_are_settled_by_every_column(spark):
    copies = [(*ORDER[:6], qty, price, *ORDER[8:]) for qty in (3, 1, 2) for price in (9, 8)]
    for order in (copies, copies[::-1]):
        orders = spark.createDataFrame(order, schemas.ORDERS).repartition(5)
        rows = dedupe(orders, ["order_id", "sku"]).collect()
        assert [(r.qty, r.unit_price) for r in rows] == [(1, 8)]


def test_copies_leave_the_map_tasks_as_one_row(spark):
    """The first-row limit stands below the exchange as well as above it."""
    plan = dedupe(spark.createDataFrame([ORDER], schemas.ORDERS), ["order_id", "sku"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_an_order_with_most_shipments_is_split(spark):
    """Half of all shipments belong to one order; AQE cuts them up in the join that keeps every shipment."""
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in limits}
    shipments = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "O0").otherwise(F.concat(F.lit("O"), "id")).alias("order_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("carrier"),
        F.lit(T0).alias("ship_ts"), F.lit(T0).alias("delivered_ts"), F.lit("DELIVERED").alias("delivery_status"),
    )
    lines = spark.range(0, 10, 1, 2).select(F.concat(F.lit("O"), "id").alias("order_id"), F.col("id").alias("line"))
    try:
        for name, value in limits.items():
            spark.conf.set(name, value)
        joined = attach_shipments(lines, shipments, "all").groupBy("line").agg(
            F.count("carrier").alias("n"), F.max("carrier")
        )
        counts = {r.line: r.n for r in joined.collect()}
        assert counts == {0: 50_000} | {i: i % 2 for i in range(1, 10)}
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _digest(df):
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).collect()[0]
    return tuple(row)


def test_same_result_on_any_partitioning(spark, sf):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    digests = set()
    try:
        for partitions in ("1", "8", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            orders = entry.views.raw_order_lines(spark, sf).orderBy(F.rand(int(partitions)))
            facts = build_order_facts(
                orders, entry._inventory(spark, sf), entry._shipments(spark, sf),
                entry._options(),
            )
            digests.add(_digest(facts))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(digests) == 1


def test_known_totals(spark):
    latest, every = entry._facts(spark, MEDIUM), entry._facts(spark, MEDIUM, shipments="all")
    measure = [
        F.count(F.lit(1)), F.sum("order_value"), F.sum(F.when(F.col("stockout_flag"), F.col("order_value"))),
        F.count_if("stockout_flag"), F.count_if(F.col("stockout_flag").isNull()),
    ]
    assert tuple(latest.agg(*measure).collect()[0]) == (57912, 1396432124, 882904082, 27456, 1087)
    assert tuple(every.agg(*measure).collect()[0]) == (108070, 2605734197, 1647093302, 51214, 2021)


def test_invariants(spark, sf):
    facts = entry._facts(spark, sf)
    assert facts.count() == facts.select("order_id", "sku").distinct().count() == 5694
    assert entry._asof(spark, sf).where("snapshot_ts > order_ts").count() == 0
    shipments = latest_shipments(entry._shipments(spark, sf))
    assert shipments.count() == shipments.select("order_id").distinct().count()


def test_stock_by_keeps_the_stock_region(spark):
    _, stock, _ = frames(spark)
    assert stock_by(stock, ("sku", "region")).columns == [
        "sku", "region", "snapshot_ts", "warehouse_id", "on_hand_qty", "inventory_region"
    ]


def test_every_shipment_matches_the_lines_once(spark, sf):
    """The match runs once: one shuffle of the matched lines by order serves both joins."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = entry._facts(spark, sf, shipments="all")
        facts.collect()
        plan = facts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_order = [x for x in plan.splitlines() if "Exchange hashpartitioning(_order" in x and "Reused" not in x]
    assert len(by_order) == 3  # the lines, the shipments, their distinct ids
    assert sum(("last(_snap" in x or "last(_last" in x) and "Window" in x for x in plan.splitlines()) == 2  # of one match and its seeds


def test_revenue_reads_no_shipment(spark, sf):
    plan = entry.queries()["revenue_summary"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "l_linestatus" not in plan and "ship_ts" not in plan


def test_a_delivered_shipment_wins_at_equal_times(spark):
    rows = [("O1", "UPS", T0, None, "IN_TRANSIT"), ("O1", "UPS", T0, T0 + timedelta(hours=1), "delivered"),
            ("O2", "UPS", T0, T0, "Delivered"), ("O2", "UPS", T0, T0 + timedelta(hours=1), "DELIVERED")]
    shipments = schemas.conform_shipments(spark.createDataFrame(rows, schemas.SHIPMENTS))
    got = {r.order_id: r.delivery_status for r in latest_shipments(shipments).collect()}
    assert got == {"O1": "delivered", "O2": "DELIVERED"}


@pytest.mark.parametrize("policy", ["latest", "all", "none"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_facts_by_way_of_written_steps(spark, tmp_path, policy, how):
    """The same rows; a step holds what facts are made of and no more, and the match reads the written lines."""
    orders, stock, shipments = frames(spark)
    options, steps = Options(how=how, shipments=policy), {}

    def written(df, step):
        steps[step] = df.columns
        write_table(df, str(tmp_path / step))
        return read_table(spark, str(tmp_path / step), schema=df.schema)

    plain = line_facts(order_lines(orders, options), stock, shipments, options)
    staged = line_facts(order_lines(orders, options), stock, shipments, options, written=written)
    assert sorted(map(repr, staged.collect())) == sorted(map(repr, plain.collect()))
    assert list(steps) == (["lines", "matched"] if policy == "all" else ["lines"])
    assert not {"channel", "discount", "order_status", "promised_delivery_ts"} & set(steps["lines"])
    assert any("/lines/" in f for f in staged.inputFiles()) or policy == "all"


@pytest.mark.parametrize("name", ["order_facts", "scan_order_facts_json", "facts_by_month", "revenue_latest_month"])
def test_whole_facts_are_made_of_written_steps(spark, sf, monkeypatch, name):
    """Lines, match and months each write what they shuffled for, so that their shuffle files never lie side by side."""
    steps, write = [], entry.write_table
    monkeypatch.setattr(entry, "write_table", lambda df, path, *more: (steps.append(path.rsplit("/", 1)[1]), write(df, path, *more)))
    entry.queries()[name](spark, sf)
    wanted = {"order_facts": ["lines", "matched"], "scan_order_facts_json": ["lines"]}
    assert steps == wanted.get(name, ["lines", "facts"])


def test_line_items_are_not_shuffled_for_a_few_suppliers(spark, sf):
    """Suppliers, small as a table, are broadcast although Spark takes a join of theirs for large."""
    inventory = entry._inventory(spark, sf)
    inventory.collect()
    plan = inventory._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange hashpartitioning(l_suppkey" not in plan


def test_the_match_shuffles_no_stock_column_that_is_not_taken(spark):
    _, stock, _ = frames(spark)
    lines = spark.createDataFrame([("O1", "A", T0)], "order_id string, sku string, order_ts timestamp_ntz")
    matched = match_inventory(lines, stock, take=("warehouse_id", "on_hand_qty"))
    assert matched.columns == [*lines.columns, "warehouse_id", "on_hand_qty"]
    assert "inventory_region" not in matched._jdf.queryExecution().executedPlan().toString()
