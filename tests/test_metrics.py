"""Metrics, cards and reports on hand-made facts."""

from __future__ import annotations

from datetime import datetime

import pytest

import __spark_entry__ as entry
from orderlens import schemas
from orderlens.functions import microseconds_between
from orderlens.plans import cards, insights, metrics

T0 = datetime(2024, 1, 10)


def facts(spark, *rows):
    """Rows of (order_id, sku, region, value, flag, warehouse, status)."""
    full = [
        (o, s, "C", 1, v, v, 1, flag, w, r, status, "UPS", T0, T0, T0)
        for o, s, r, v, flag, w, status in rows
    ]
    return spark.createDataFrame(full, schemas.ORDER_FACTS).drop("ingestion_ts")


def rows(df):
    columns = sorted(df.columns)
    return sorted(([r[c] for c in columns] for r in df.collect()), key=str)


MIXED = [
    ("O1", "A", "West", 10, True, "W1", "delivered"),
    ("O1", "B", "West", 20, False, "W1", "Delivered"),
    ("O2", "A", None, 30, None, "W1", "DELIVERED"),
    ("O3", "A", None, 40, True, None, "IN_TRANSIT"),
    ("O4", "B", "East", None, True, "W2", None),
    (None, "B", "East", 60, True, "W2", None),
    ("O6", None, "East", 70, False, "W2", None),
]


def test_revenue_needs_id_sku_and_value(spark):
    df = facts(spark, *MIXED)
    total = metrics.revenue(df).collect()[0].asDict()
    assert total == dict(total_revenue=100, total_orders=4, avg_order_value=25.0)
    by_region = {r.region: (r.total_revenue, r.total_orders) for r in metrics.revenue(df, "region").collect()}
    assert by_region == {"West": (30, 2), None: (70, 2)}
    distinct = metrics.revenue(df, distinct_orders=True).collect()[0]
    assert (distinct.total_orders, distinct.distinct_orders) == (4, 3)


def test_risk_takes_known_stockouts_only(spark):
    df = facts(spark, *MIXED)
    assert metrics.revenue_at_risk(df).collect()[0].asDict() == dict(
        total_revenue_at_risk=110, stockout_orders=3
    )
    by_region = {r.region: tuple(r)[1:] for r in metrics.revenue_at_risk(df, "region").collect()}
    assert by_region == {"West": (10, 1), None: (40, 1), "East": (60, 1)}


def test_supply_chain_needs_a_warehouse_and_ignores_case(spark):
    assert metrics.supply_chain(facts(spark, *MIXED)).collect()[0].asDict() == dict(
        total_order_lines=4,
        stockout_order_lines=2,
        stockout_rate=0.5,
        delivered_order_lines=3,
        delivery_success_rate=0.75,
    )


def test_nothing_at_risk(spark):
    df = facts(spark, ("O1", "A", "West", 10, False, "W1", None))
    assert tuple(metrics.revenue_at_risk(df).collect()[0]) == (0, 0)
    assert metrics.revenue_at_risk(df, "sku").count() == 0
    card = cards.risk_card(metrics.revenue_at_risk(df)).collect()
    assert [tuple(r) for r in card] == [(0, 0, "healthy")]


def test_empty_facts(spark):
    df = facts(spark)
    assert tuple(metrics.revenue(df).collect()[0]) == (None, 0, None)
    assert tuple(metrics.revenue_at_risk(df).collect()[0]) == (0, 0)
    assert tuple(metrics.supply_chain(df).collect()[0]) == (0, 0, 0, None, None)
    assert metrics.revenue(df, "region").count() == 0


@pytest.mark.parametrize("case", ["mixed", "empty", "given"])
def test_one_pass_equals_single_datasets(spark, sf, case):
    made = {"mixed": MIXED, "empty": []}
    df = facts(spark, *made[case]) if case in made else entry._facts(spark, sf)
    single = metrics.revenue_kpis(df) | metrics.risk_metrics(df) | metrics.supply_metrics(df)
    together = metrics.all_metrics(metrics.metric_totals(df))
    assert set(single) == set(together) and len(single) == 7
    for name in single:
        assert sorted(single[name].columns) == sorted(together[name].columns)
        assert rows(single[name]) == rows(together[name]), name
        assert dict(single[name].dtypes) == dict(together[name].dtypes)


def test_groups_add_up(spark, sf):
    df = entry._facts(spark, sf)
    total = metrics.revenue(df).collect()[0].total_revenue
    for group in ("region", "sku"):
        assert metrics.revenue(df, group).agg({"total_revenue": "sum"}).collect()[0][0] == total
    assert metrics.revenue_at_risk(df).collect()[0].total_revenue_at_risk <= total


def test_cards(spark):
    summary = spark.createDataFrame([(10, 3, 2.345)], "total_revenue bigint, total_orders bigint, avg_order_value double")
    assert tuple(cards.revenue_card(summary).collect()[0]) == (10, 3, 2.35)
    missing = spark.createDataFrame([(None,)], "total_revenue_at_risk bigint")
    assert tuple(cards.risk_card(missing).collect()[0]) == (0, 0, "healthy")
    assert tuple(cards.risk_card(missing.limit(0)).collect()[0]) == (0, 0, "healthy")
    loss = spark.createDataFrame([(5, 1)], "total_revenue_at_risk bigint, stockout_orders bigint")
    assert tuple(cards.risk_card(loss).collect()[0]) == (5, 1, "loss")


def test_ranks_with_ties_nulls_and_wide_values(spark):
    totals = [("W", f"S{i}", v) for i, v in enumerate([5, 5, 0, -3, 10**12, 10**12 + 1, 7])]
    totals += [(None, "S1", 4), (None, "S2", 9), ("E", "S1", None)]
    df = spark.createDataFrame(totals, "region string, sku string, total_revenue bigint")
    got = {(r.region, r.sku): r.revenue_rank for r in insights.sku_rank_in_region(df).collect()}
    want = {
        (region, sku): 1 + sum(1 for r, _, w in totals if r == region and w is not None and w > v)
        for region, sku, v in totals
        if v is not None
    }
    assert got == want


def test_latency_and_carriers(spark):
    lines = spark.createDataFrame(
        [("O1", "A", datetime(2024, 1, 11)), ("O2", "A", datetime(2024, 1, 20)), ("O3", "A", None)],
        "order_id string, sku string, promised_delivery_ts timestamp_ntz",
    )
    shipments = schemas.conform_shipments(
        spark.createDataFrame(
            [
                ("O1", "UPS", datetime(2024, 1, 10, 6), datetime(2024, 1, 11, 12, 30), "DELIVERED"),
                ("O2", "UPS", datetime(2024, 1, 10), datetime(2024, 1, 10, 1), "delivered"),
                ("O4", "USPS", datetime(2024, 1, 10), None, "IN_TRANSIT"),
            ],
            schemas.SHIPMENTS,
        )
    )
    found = {r.order_id: (r.latency_hours, r.late) for r in insights.delivery_latency(lines, shipments).collect()}
    assert found == {"O1": (30.5, True), "O2": (1.0, False), "O3": (None, None)}
    carriers = {r.carrier: tuple(r)[1:] for r in insights.carrier_performance(shipments).collect()}
    assert carriers == {"UPS": (2, 2, 1.0, 15.75), "USPS": (1, 0, 0.0, None)}


def test_scans_read_only_what_they_need(spark, sf, tmp_path):
    """Filters and columns of a metric reach the Parquet scan, and nothing runs in Python."""
    entry._facts(spark, sf).write.parquet(str(tmp_path / "facts"))
    table = spark.read.parquet(str(tmp_path / "facts"))
    plan = metrics.revenue(table, "region")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    for pushed in ("IsNotNull(order_id)", "IsNotNull(sku)", "IsNotNull(order_value)"):
        assert pushed in scan
    assert "customer_id" not in scan and "ship_ts" not in scan
    assert "Python" not in plan
    assert plan.count("Exchange") == 1


def test_latency_counts_microseconds(spark):
    start, end = datetime(2024, 1, 10, 10, 0, 0, 900_000), datetime(2024, 1, 10, 10, 0, 1, 100_000)
    rows = [("O1", "UPS", start, end, "DELIVERED"), ("O2", "USPS", end, start, "DELIVERED")]
    rows += [("O3", "DHL", datetime(2024, 3, 9, 23, 59, 59, 999_999), datetime(2024, 3, 11, 0, 0, 0, 1), "DELIVERED")]
    shipments = schemas.conform_shipments(spark.createDataFrame(rows, schemas.SHIPMENTS))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {r.carrier: r.avg_latency_hours for r in insights.carrier_performance(shipments).collect()}
        assert got == {"UPS": 0.000056, "USPS": -0.000056, "DHL": 24.0}
        exact = shipments.select("order_id", microseconds_between("ship_ts", "delivered_ts").alias("n")).collect()
        assert {r.order_id: r.n for r in exact} == {"O1": 200_000, "O2": -200_000, "O3": 86_400_000_002}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_latencies_beyond_a_bigint(spark):
    """Forty shipments of eight thousand years: their microseconds do not fit a bigint."""
    first, last = datetime(1000, 1, 1), datetime(9000, 1, 1)
    shipments = spark.createDataFrame([("O", "UPS", first, last, "DELIVERED")] * 40, schemas.SHIPMENTS)
    row = insights.carrier_performance(schemas.conform_shipments(shipments)).collect()[0]
    hours = (last - first).total_seconds() / 3600
    assert (row.shipments, row.avg_latency_hours) == (40, hours)


def test_sketches_and_exact_counts_read_facts_that_were_written_once(spark, tmp_path, monkeypatch):
    """The point-in-time join behind the facts runs once, not once for each of them."""
    lines = [("EU", "A", "O1", 5), ("EU", "A", "O1", 5), ("EU", "B", "O1", 1), ("EU", "B", "O2", 1), ("US", "A", "O3", 2)]
    made = spark.createDataFrame(lines, "region string, sku string, order_id string, order_value bigint")
    monkeypatch.setattr(entry, "_facts", lambda *args, **chosen: made)
    found = entry.core_queries()["distinct_orders_sketch"](spark, str(tmp_path))
    assert found.inputFiles() and all("/sketch_facts/" in f for f in found.inputFiles())
    assert sorted(tuple(r) for r in found.collect()) == [("EU", 2, True), ("US", 1, True)]
