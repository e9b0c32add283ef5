"""

Every query runs over the whole given tables. The oracle SQL is written from the definitions, pairwise matching
and all, so it shares no plan with the engine.
"""

from __future__ import annotations

import hashlib
import importlib
import os
import sys
import uuid
import warnings
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens import schemas, testviews as views
from orderlens.operators import (
    latest_by,
    normalise_status,
    order_ids,
    orders_without_shipment,
    require,
    shipments_for,
    status_values,
    stockouts,
)
from orderlens.operators.quality import KPI_COLUMNS, SUPPLY_COLUMNS
from orderlens.plans import cards, facts as fact_plan, incremental, insights, metrics, months, sketches, state
from orderlens.functions import microseconds_between, stamp
from orderlens.plans.pipeline import Paths, compact_ingested, ingest, run_changes, run_pipeline, vacuum_ingested
from orderlens.sources import (
    bad_records,
    good_records,
    land_batch,
    landed_schema,
    load_metrics,
    read_landing_json,
    read_table,
    shared_dir,
    shuffles_removed,
    write_metrics,
    write_table,
)
from orderlens.sources.sinks import RECORDS_A_FILE
from orderlens.streaming import Once, compact, convert_new_batches, read_converted, vacuum

Query = Callable[[SparkSession, str], DataFrame]

# Landed text is many times the given tables, so it is packed.
_PACKED = "gzip"


def _raw_orders(spark, sf):
    return views.raw_order_lines(spark, sf)


def _orders(spark, sf):
    return schemas.conform_orders(_raw_orders(spark, sf))


def _inventory(spark, sf):
    return schemas.conform_inventory(views.raw_inventory(spark, sf))


def _shipments(spark, sf):
    return schemas.conform_shipments(views.raw_shipments(spark, sf))


def _options(**chosen) -> fact_plan.Options:
    return fact_plan.Options(dedupe_order=views.LINE_ORDER, **chosen)


def _lines(spark, sf):
    lines = fact_plan.order_lines(
        _raw_orders(spark, sf), _options()
    )
    return schemas.conform_orders(lines)


def _facts(spark, sf, **chosen):
    return fact_plan.build_order_facts(
        _raw_orders(spark, sf),
        _inventory(spark, sf),
        _shipments(spark, sf),
        _options(**chosen),
        views.line_skus(spark, sf),
    )


def _staged_facts(spark, sf, name: str, more=(), **chosen) -> DataFrame:
    """The facts by way of written steps: the shuffles of one are off the disk before the next makes its own."""

    def written(df: DataFrame, step: str) -> DataFrame:
        path = _work(spark, sf, f"{name}_steps/{step}")
        write_table(df, path)
        return read_table(spark, path, schema=df.schema)

    lines = _lines(spark, sf)
    if months.MONTH in more:
        lines = lines.withColumn(months.MONTH, months.month_of())
    return fact_plan.line_facts(
        lines, _inventory(spark, sf), _shipments(spark, sf), _options(**chosen), more, written=written
    )


_ASOF_COLUMNS = (
    "order_id", "order_ts", "region", "sku", "qty", "snapshot_ts", "warehouse_id", "on_hand_qty"
)


def _asof(spark, sf, **chosen):
    matched = fact_plan.match_inventory(
        _lines(spark, sf), _inventory(spark, sf), _options(**chosen), views.line_skus(spark, sf)
    )
    return matched.select(*_ASOF_COLUMNS)


def _latest_snapshot(spark, sf):
    newest_first = [
        F.col("snapshot_ts").desc_nulls_last(),
        F.col("warehouse_id").asc_nulls_last(),
        F.col("on_hand_qty").asc_nulls_last(),
        F.col("inventory_region").asc_nulls_last(),
    ]
    return latest_by(_inventory(spark, sf), ["sku"], newest_first)


def _work(spark: SparkSession, sf: str, name: str) -> str:
    """A folder of this application, table folder and query in the shared folder."""
    tables = hashlib.sha256(sf.rstrip("/").encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/orderlens/{spark.sparkContext.applicationId}/{tables}/{name}"


def _scan_facts(spark, sf):
    path = _work(spark, sf, "scan_order_facts")
    write_table(_facts(spark, sf), path)
    return read_table(spark, path)


def _scan_facts_json(spark, sf):
    path = _work(spark, sf, "scan_order_facts_json")
    facts = _staged_facts(spark, sf, "scan_order_facts_json")
    writer = facts.write.mode("overwrite").option("compression", _PACKED)
    with shuffles_removed(spark):
        writer.option("maxRecordsPerFile", RECORDS_A_FILE).json(path)
    return read_table(spark, path, "json", schemas.ORDER_FACTS).drop("ingestion_ts")


def _land(spark, sf, name: str, raw: DataFrame, schema) -> str:
    path = f"{_work(spark, sf, 'landing')}/{name}"
    land_batch(raw.select(*schema.fieldNames()), path, "b1", compression=_PACKED)
    return path


def _landed(name: str, view, schema, conform) -> Query:
    """Lands a raw table as JSON text, scans it by its declared text schema and parses it."""

    def run(spark, sf):
        path = _land(spark, sf, name, view(spark, sf), schema)
        return conform(good_records(read_landing_json(spark, path, schema)))

    return run


def _arrays(spark, sf) -> DataFrame:
    """Landed text with one array of records per order: (order_id, sku, value), the SKU null without a line."""
    names = [c for c in schemas.ORDERS.fieldNames() if c not in ("order_ts", "promised_delivery_ts")]
    times = [F.col(c).cast("string").alias(c) for c in ("order_ts", "promised_delivery_ts")]
    rows = _raw_orders(spark, sf).select(*names, *times)
    return rows.groupBy("order_id").agg(
        F.max("sku").alias("sku"), F.to_json(F.collect_list(F.struct(*names, *times))).alias("value")
    )


def _landed_arrays(spark, sf):
    """Arrays of an order's records, one per line, in several areas read through one glob."""
    base = _work(spark, sf, "landing/arrays")
    arrays = _arrays(spark, sf)
    for k in range(2):
        arrays.where(F.crc32("order_id") % 2 == k).select("value").write.mode("overwrite").text(f"{base}/part={k}")
    landed = read_landing_json(spark, f"{base}/part=*", schemas.ORDERS, files="*.txt")
    return schemas.conform_orders(good_records(landed))


def _mixture(spark, sf) -> DataFrame:
    """Arrays, single objects for orders of one line, and a broken line for every order without one."""
    value = (
        F.when(F.col("sku").isNull(), F.concat(F.lit('{"order_id": "'), "order_id", F.lit('", ')))
        .when(F.get_json_object("value", "$[1]").isNull(), F.expr("substr(value, 2, length(value) - 2)"))
        .otherwise(F.col("value"))
    )
    path = _work(spark, sf, "landing/mixed")
    _arrays(spark, sf).select(value.alias("value")).write.mode("overwrite").text(path)
    return read_landing_json(spark, path, schemas.ORDERS, files="*.txt")


def _landed_incremental(spark, sf):
    """Two batches of shipments, the first one replaced after both were taken in by the stream."""
    base = _work(spark, sf, "landing/incremental")
    base = f"{base}-{uuid.uuid4().hex}"  # the stream remembers what it has seen
    raw = views.raw_shipments(spark, sf)
    delivered = F.col("status") == "DELIVERED"

    def ingested():
        return ingest(spark, f"{base}/landing", schemas.SHIPMENTS, f"{base}/shipments", False, True)

    land_batch(raw.where(delivered).withColumn("carrier", F.lit("wrong")), f"{base}/landing", "b1", compression=_PACKED)
    land_batch(raw.where(~delivered), f"{base}/landing", "b2", compression=_PACKED)
    ingested()
    land_batch(raw.where(delivered), f"{base}/landing", "b1", compression=_PACKED)
    return schemas.conform_shipments(ingested())


def _landed_compacted(spark, sf):
    """Loads of three batches, one of them replaced, rewritten into one folder; the folders before it are taken away."""
    base = f"{_work(spark, sf, 'landing/compacted')}-{uuid.uuid4().hex}"
    raw, table = views.raw_shipments(spark, sf), f"{base}/shipments_appended"
    share = F.pmod(F.crc32("order_id"), F.lit(3))

    def ingested():
        return ingest(spark, f"{base}/landing", schemas.SHIPMENTS, f"{base}/shipments", False, True)

    for k in range(3):
        wrong = raw.where(share == k).withColumn("carrier", F.lit("wrong")) if k == 0 else raw.where(share == k)
        land_batch(wrong, f"{base}/landing", f"b{k}", compression=_PACKED)
        ingested()
    land_batch(raw.where(share == 0), f"{base}/landing", "b0", compression=_PACKED)
    ingested()
    compact(spark, table, landed_schema(schemas.SHIPMENTS), f"{base}/landing")
    vacuum(spark, table)
    return schemas.conform_shipments(ingested())


def _deduped_stream(spark, sf):
    """Lines landed in three batches with copies of whole orders, copies left out as they stream in."""
    base = f"{_work(spark, sf, 'landing/once')}-{uuid.uuid4().hex}"
    write_table(_lines(spark, sf).where("sku IS NOT NULL"), f"{base}/lines")
    lines = read_table(spark, f"{base}/lines", schema=schemas.ORDERS)
    once, table = Once(("order_id", "sku"), "1 day"), f"{base}/orders"
    for k in range(3):
        part = lines.where(F.pmod(F.crc32("order_id"), F.lit(3)).isin(k, (k + 1) % 3))
        land_batch(part, f"{base}/landing", f"b{k}", compression=_PACKED)
        convert_new_batches(spark, f"{base}/landing", schemas.ORDERS, table, f"{base}/progress", once=once).awaitTermination()
    return schemas.conform_orders(good_records(read_converted(spark, table, schemas.ORDERS)))


def _stamped(spark, sf):
    """Whether every row of a written fact table carries one and the same load time."""
    path = _work(spark, sf, "stamped")
    write_table(stamp(_facts(spark, sf, shipments="none"), "ingestion_ts"), path)
    load = F.col("ingestion_ts")
    return read_table(spark, path).agg(
        F.count(F.lit(1)).alias("fact_rows"),
        (F.count(load) == F.count(F.lit(1))).alias("all_stamped"),
        (F.min(load) == F.max(load)).alias("one_time"),
    )


def _run(spark, sf, name: str) -> Paths:
    base = _work(spark, sf, f"pipeline/{name}")
    landing = {
        table: _land(spark, sf, f"{name}/{table}", view(spark, sf), schema)
        for table, view, schema in (
            ("orders", views.raw_order_lines, schemas.ORDERS),
            ("inventory", views.raw_inventory, schemas.INVENTORY),
            ("shipments", views.raw_shipments, schemas.SHIPMENTS),
        )
    }
    paths = Paths(**landing, silver=f"{base}/silver", gold=f"{base}/gold")
    run_pipeline(spark, paths)
    return paths


def _pipeline(dataset: str) -> Query:
    """Landing to gold, every layer written; returns one gold dataset as a report would load it."""
    return lambda spark, sf: load_metrics(spark, _run(spark, sf, dataset).gold, dataset).drop("metric_generated_ts")


def _changes(spark, sf):
    """Two rounds of landed batches, each applied by a run that writes only what changed; revenue by region after both."""
    base = f"{_work(spark, sf, 'pipeline/changes')}-{uuid.uuid4().hex}"
    areas = {n: f"{base}/landing/{n}" for n in ("orders", "inventory", "shipments")}
    paths = Paths(**areas, silver=f"{base}/silver", gold=f"{base}/gold")
    given = (
        ("orders", views.raw_order_lines, schemas.ORDERS),
        ("inventory", views.raw_inventory, schemas.INVENTORY),
        ("shipments", views.raw_shipments, schemas.SHIPMENTS),
    )
    for k in range(2):
        for name, view, schema in given:
            raw = view(spark, sf).select(*schema.fieldNames())
            share = F.pmod(F.xxhash64(*raw.columns), F.lit(10)) >= 8
            land_batch(raw.where(share == bool(k)), areas[name], f"b{k}", compression=_PACKED)
        run_changes(spark, paths)
        compact_ingested(spark, paths)
        vacuum_ingested(spark, paths)
    return load_metrics(spark, paths.gold, "revenue_kpis/by_region").drop("metric_generated_ts")


def _layer_counts(spark, sf):
    """What a whole run counted in each layer while it wrote it."""
    return read_table(spark, _run(spark, sf, "layer_counts").counts)


def _distinct_orders_sketch(spark, sf):
    """Sketches per region and SKU merged to regions, beside the exact numbers of the same facts."""
    facts = _written_facts(spark, sf, "sketch_facts")
    merged = sketches.merged_orders(sketches.order_sketches(facts, "region", "sku"), "region")
    near = sketches.distinct_orders(merged).withColumnRenamed("distinct_orders", "estimate")
    exact = metrics.revenue(facts, "region", distinct_orders=True).select("region", "distinct_orders")
    close = F.abs(F.col("estimate") - F.col("distinct_orders")) <= 0.03 * F.col("distinct_orders")
    return exact.join(near, "region").select("region", "distinct_orders", close.alias("within_3_percent"))


def _latency_quantiles(spark, sf):
    """Sketches per carrier and month merged to carriers, and whether the true ranks of their quantiles are near."""
    shipped = _shipments(spark, sf).withColumn(months.MONTH, months.month_of("ship_ts"))
    merged = sketches.merged_latencies(sketches.latency_sketches(shipped, "carrier", months.MONTH), "carrier")
    found = sketches.latency_quantiles(merged)
    taken = shipped.select("carrier", microseconds_between("ship_ts", "delivered_ts").alias("taken"))
    ranks = taken.where("taken IS NOT NULL").join(found, "carrier").groupBy("carrier", "quantile", "timed").agg(
        (F.count_if(F.col("taken") < F.col("latency_us")) / F.count("taken")).alias("below"),
        (F.count_if(F.col("taken") <= F.col("latency_us")) / F.count("taken")).alias("upto"),
    )
    near = (F.col("below") <= F.col("quantile") + 0.02) & (F.col("upto") >= F.col("quantile") - 0.02)
    return ranks.select("carrier", "quantile", "timed", near.alias("rank_within_2_percent"))


def _after_batches(spark, sf, name: str) -> incremental.Store:
    """All rows in two batches: copies of a line, snapshots of a time before and shipments of an order come in either."""
    store = incremental.Store(f"{_work(spark, sf, name)}-{uuid.uuid4().hex}")
    given = (_orders(spark, sf), _inventory(spark, sf), _shipments(spark, sf))
    for k in range(2):
        share = [df.where((F.pmod(F.xxhash64(*df.columns), F.lit(10)) >= 7) == bool(k)) for df in given]
        incremental.apply_batch(spark, store, f"b{k}", *share)
    return store


def _facts_by_month(spark, sf, name: str, **chosen) -> DataFrame:
    """The facts with their order month, written in a folder per month and read back."""
    path, aside = _work(spark, sf, name), _work(spark, sf, f"{name}_steps/facts")
    facts = _staged_facts(spark, sf, name, [months.MONTH], **chosen)
    # Dealing them by month is a shuffle of its own, made when those of the match are gone.
    write_table(facts, aside)
    months.write_by_month(read_table(spark, aside, schema=facts.schema), path, replace_all=True)
    return months.read_months(spark, path)


def _latest_month(spark, sf):
    """Revenue by region of the latest month with orders; the scan opens that month's folder only."""
    facts = _facts_by_month(spark, sf, "latest_month", shipments="none")
    return metrics.revenue(months.of_months(facts, months.last_months(facts)), months.MONTH, "region")


def _written_facts(spark, sf, name: str) -> DataFrame:
    """What revenue needs of the facts, written once for those that read it several times."""
    path = _work(spark, sf, name)
    write_table(_facts(spark, sf, shipments="none").select("region", *KPI_COLUMNS), path)
    return read_table(spark, path)


def _loaded_metrics(spark, sf):
    base = _work(spark, sf, "metrics")
    write_metrics(metrics.revenue_kpis(_written_facts(spark, sf, "metrics_facts")), base)
    return load_metrics(spark, base, "revenue_kpis/by_region")


def _sku_rank(spark, sf):
    path = _work(spark, sf, "sku_revenue")
    write_table(metrics.revenue(_facts(spark, sf, shipments="none"), "region", "sku"), path)
    return insights.sku_rank_in_region(read_table(spark, path))


def _on_facts(build: Callable[[DataFrame], DataFrame], **chosen) -> Query:
    return lambda spark, sf: build(_facts(spark, sf, **chosen))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: revenue by region over the point-in-time facts."""
    return queries()["revenue_by_region"](spark, "/root/testdata/sf0.001")


def _training_data(part: str) -> dict:
    """What the subpackage for training data registers; nothing where it, or a library it needs, cannot be imported."""
    try:
        module = importlib.import_module("orderlens.llm.queries")
    except ImportError as missing:
        warnings.warn(f"the queries for training data are left out: {missing}", stacklevel=2)
        return {}
    return dict(getattr(module, part))


def queries() -> dict[str, Query]:
    return core_queries() | _training_data("QUERIES")


def oracle_sql() -> dict[str, str]:
    return core_oracle_sql() | _training_data("ORACLE_SQL")


def core_queries() -> dict[str, Query]:
    every_shipment, no_shipment = {"shipments": "all"}, {"shipments": "none"}
    return {
        # scans, landing and sinks
        "scan_order_facts": _scan_facts,
        "scan_order_facts_json": _scan_facts_json,
        "landed_orders": _landed(
            "orders", views.raw_order_lines, schemas.ORDERS, schemas.conform_orders
        ),
        "landed_inventory": _landed(
            "inventory", views.raw_inventory, schemas.INVENTORY, schemas.conform_inventory
        ),
        "landed_shipments": _landed(
            "shipments", views.raw_shipments, schemas.SHIPMENTS, schemas.conform_shipments
        ),
        "landed_arrays": _landed_arrays,
        "landed_mixed": lambda spark, sf: schemas.conform_orders(good_records(_mixture(spark, sf))),
        "rejected_records": lambda spark, sf: bad_records(_mixture(spark, sf)).select(
            F.col("_corrupt_record").alias("record")
        ),
        "landed_incremental": _landed_incremental,
        "landed_compacted": _landed_compacted,
        "landed_once": _deduped_stream,
        "load_metrics_by_region": _loaded_metrics,
        "stamped": _stamped,
        "facts_by_month": lambda spark, sf: _facts_by_month(spark, sf, "facts_by_month"),
        # batches
        "facts_after_batch": lambda spark, sf: incremental.facts_now(
            spark, _after_batches(spark, sf, "facts_after_batch")
        ),
        "metric_state": lambda spark, sf: state.totals(
            incremental.state_now(spark, _after_batches(spark, sf, "metric_state"))
        ),
        # projections and filters
        "conform_inventory": _inventory,
        "conform_shipments": _shipments,
        "order_value": _on_facts(
            lambda f: f.select("order_id", "sku", "quantity", "price", "order_value"), **no_shipment
        ),
        "stockout_flag": _on_facts(
            lambda f: f.select("order_id", "sku", "inventory_at_order_time", "quantity", "stockout_flag"),
            **no_shipment,
        ),
        "quality_kpi": _on_facts(lambda f: require(f, *KPI_COLUMNS), how="left"),
        "quality_supply": _on_facts(lambda f: require(f, *SUPPLY_COLUMNS), how="left"),
        "stockout_lines": _on_facts(stockouts),
        "status_normalised": _on_facts(
            lambda f: normalise_status(f).select(
                "order_id", "sku", "delivery_status", "delivery_status_clean"
            )
        ),
        # joins
        "shipments_for_orders": lambda spark, sf: shipments_for(
            _lines(spark, sf), _shipments(spark, sf)
        ),
        "orders_without_shipment": lambda spark, sf: orders_without_shipment(
            _lines(spark, sf), _shipments(spark, sf)
        ),
        "asof_inventory": _asof,
        "asof_inventory_left": lambda spark, sf: _asof(spark, sf, how="left"),
        "asof_inventory_region": lambda spark, sf: _asof(spark, sf, keys=("sku", "region")),
        "order_facts": lambda spark, sf: _staged_facts(spark, sf, "order_facts", **every_shipment),
        "order_facts_latest": _on_facts(lambda f: f),
        # reductions
        "dedupe_order_lines": _lines,
        "latest_snapshot_by_sku": _latest_snapshot,
        "distinct_order_ids": lambda spark, sf: order_ids(_orders(spark, sf)),
        "status_values": _on_facts(status_values),
        # metrics
        "revenue_summary": _on_facts(metrics.revenue, **no_shipment),
        "revenue_by_region": _on_facts(lambda f: metrics.revenue(f, "region"), **no_shipment),
        "revenue_by_sku": _on_facts(lambda f: metrics.revenue(f, "sku"), **no_shipment),
        "revenue_latest_month": _latest_month,
        "revenue_distinct_orders": _on_facts(
            lambda f: metrics.revenue(f, "region", distinct_orders=True), **no_shipment
        ),
        "revenue_summary_fanout": _on_facts(metrics.revenue, **every_shipment),
        "risk_summary": _on_facts(metrics.revenue_at_risk, **no_shipment),
        "risk_by_sku": _on_facts(lambda f: metrics.revenue_at_risk(f, "sku"), **no_shipment),
        "risk_by_region": _on_facts(lambda f: metrics.revenue_at_risk(f, "region"), **no_shipment),
        "risk_summary_fanout": _on_facts(metrics.revenue_at_risk, **every_shipment),
        "supply_chain_summary": _on_facts(metrics.supply_chain),
        "supply_chain_summary_fanout": _on_facts(metrics.supply_chain, **every_shipment),
        "metric_totals": _on_facts(metrics.metric_totals),
        # report figures
        "revenue_card": _on_facts(lambda f: cards.revenue_card(metrics.revenue(f)), **no_shipment),
        "revenue_series": _on_facts(
            lambda f: cards.revenue_series(metrics.revenue(f, "region")), **no_shipment
        ),
        "risk_card": _on_facts(lambda f: cards.risk_card(metrics.revenue_at_risk(f)), **no_shipment),
        "supply_card": _on_facts(lambda f: cards.supply_card(metrics.supply_chain(f))),
        # whole runs
        "pipeline_revenue_by_region": _pipeline("revenue_kpis/by_region"),
        "pipeline_risk_by_sku": _pipeline("revenue_at_risk/by_sku"),
        "pipeline_supply_chain": _pipeline("supply_chain_metrics/summary"),
        "pipeline_changes": _changes,
        "layer_counts": _layer_counts,
        # sketches
        "distinct_orders_sketch": _distinct_orders_sketch,
        "latency_quantiles": _latency_quantiles,
        # delivery and revenue reports
        "delivery_latency": lambda spark, sf: insights.delivery_latency(
            _lines(spark, sf), _shipments(spark, sf)
        ),
        "carrier_performance": lambda spark, sf: insights.carrier_performance(_shipments(spark, sf)),
        "sku_rank_in_region": _sku_rank,
        "revenue_trend": lambda spark, sf: insights.revenue_trend(_lines(spark, sf)),
    }


_VIEWS = {
    "raw_order_lines": """
SELECT 'ORD' || CAST(o_orderkey AS STRING) AS order_id, o_orderdate AS order_ts,
       'CUST' || CAST(o_custkey AS STRING) AS customer_id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'online' ELSE 'store' END AS channel, r_name AS region,
       'SKU' || CAST(l_partkey AS STRING) AS sku, CAST(l_quantity AS BIGINT) AS qty,
       CAST(floor(p_retailprice) AS BIGINT) AS unit_price,
       CAST(round(l_discount * 100) AS BIGINT) AS discount,
       o_orderdate + INTERVAL 3 DAY AS promised_delivery_ts, o_orderstatus AS order_status,
       l_linenumber AS line_no
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "order_lines": """
SELECT * EXCLUDE (line_no, rn)
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, sku
                                   ORDER BY line_no, qty, unit_price, discount) AS rn
      FROM raw_order_lines) d
WHERE rn = 1""",
    "inventory_snapshots": """
SELECT l_shipdate AS snapshot_ts, 'W' || CAST(l_suppkey AS STRING) AS warehouse_id,
       r_name AS inventory_region, 'SKU' || CAST(l_partkey AS STRING) AS sku,
       NULLIF(CAST(l_quantity AS BIGINT), 50) AS on_hand_qty
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "all_shipments": """
SELECT 'ORD' || CAST(l_orderkey AS STRING) AS order_id,
       CASE l_orderkey % 3 WHEN 0 THEN 'UPS' WHEN 1 THEN 'FedEx' ELSE 'USPS' END AS carrier,
       min(l_shipdate) AS ship_ts,
       CASE WHEN l_linestatus = 'F' THEN max(l_shipdate) + INTERVAL 2 DAY END AS delivered_ts,
       CASE WHEN l_linestatus = 'F' THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS delivery_status
FROM lineitem
GROUP BY l_orderkey, l_linestatus""",
    "latest_shipments": """
SELECT order_id, carrier, ship_ts, delivered_ts, delivery_status
FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                                   ORDER BY ship_ts DESC, lower(delivery_status) = 'delivered' DESC NULLS LAST,
                                            delivered_ts DESC NULLS LAST, delivery_status, carrier) AS rn
      FROM all_shipments) s
WHERE rn = 1""",
}

# The last step of the pipeline's own copy removal: landed orders carry no line number.
_LANDED_LINES = """
SELECT * EXCLUDE (line_no, rn)
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, sku
                                   ORDER BY order_ts, customer_id, channel, region, qty, unit_price,
                                            discount, promised_delivery_ts, order_status) AS rn
      FROM raw_order_lines) d
WHERE rn = 1"""


def _matched_sql(match: str = "o.sku = i.sku", join: str = "JOIN") -> str:
    """Pairs every line with every earlier snapshot and keeps the newest."""
    return f"""
SELECT * EXCLUDE (rn)
FROM (SELECT o.*, i.snapshot_ts, i.warehouse_id, i.on_hand_qty,
             row_number() OVER (PARTITION BY o.order_id, o.sku
                                ORDER BY i.snapshot_ts DESC, i.warehouse_id, i.on_hand_qty NULLS LAST) AS rn
      FROM order_lines o {join} inventory_snapshots i ON {match} AND i.snapshot_ts <= o.order_ts) m
WHERE rn = 1"""


def _facts_sql(shipments: str, more: str = "") -> str:
    return f"""
SELECT {more}m.order_id, m.sku, m.customer_id, m.qty AS quantity, m.unit_price AS price,
       m.qty * m.unit_price AS order_value, m.on_hand_qty AS inventory_at_order_time,
       m.on_hand_qty < m.qty AS stockout_flag, m.warehouse_id, m.region,
       s.delivery_status, s.carrier, s.ship_ts, s.delivered_ts
FROM matched m LEFT JOIN {shipments} s ON m.order_id = s.order_id"""


def _with(body: str, **steps: str) -> str:
    named = {**_VIEWS, **steps}
    return "WITH " + ",\n".join(f"{n} AS ({sql}\n)" for n, sql in named.items()) + "\n" + body


def core_oracle_sql() -> dict[str, str]:
    def over_facts(body: str, shipments: str = "latest_shipments", join: str = "JOIN", **steps) -> str:
        steps.setdefault("matched", _matched_sql(join=join))
        return _with(body, **steps, facts=_facts_sql(shipments))

    def over_match(**how) -> str:
        columns = ", ".join(_ASOF_COLUMNS)
        return _with(f"SELECT {columns} FROM matched", matched=_matched_sql(**how))

    kpi = "order_id IS NOT NULL AND sku IS NOT NULL AND order_value IS NOT NULL"
    supply = "order_id IS NOT NULL AND sku IS NOT NULL AND warehouse_id IS NOT NULL"
    revenue = """CAST(sum(order_value) AS BIGINT) AS total_revenue, count(order_id) AS total_orders,
       avg(order_value) AS avg_order_value"""
    risk = """CAST(coalesce(sum(order_value), 0) AS BIGINT) AS total_revenue_at_risk,
       count(order_id) AS stockout_orders"""
    stockout = "CASE WHEN stockout_flag THEN 1 ELSE 0 END"
    done = "CASE WHEN lower(delivery_status) = 'delivered' THEN 1 ELSE 0 END"
    revenue_sql = f"SELECT {revenue} FROM facts WHERE {kpi}"
    region_sql = f"SELECT region, {revenue} FROM facts WHERE {kpi} GROUP BY region"
    risk_sql = f"SELECT {risk} FROM facts WHERE stockout_flag"
    risk_sku_sql = f"SELECT sku, {risk} FROM facts WHERE stockout_flag GROUP BY sku"
    supply_sql = f"""
SELECT count(order_id) AS total_order_lines,
       CAST(coalesce(sum({stockout}), 0) AS BIGINT) AS stockout_order_lines,
       CAST(coalesce(sum({done}), 0) AS BIGINT) AS delivered_order_lines,
       avg(CAST({stockout} AS DOUBLE)) AS stockout_rate,
       avg(CAST({done} AS DOUBLE)) AS delivery_success_rate
FROM facts WHERE {supply}"""
    taken = "date_diff('microsecond', ship_ts, delivered_ts)"
    landed = {"order_lines": _LANDED_LINES}
    totals = f"""SELECT region, sku,
       CAST(sum(CASE WHEN {kpi} THEN order_value END) AS BIGINT) AS kpi_value,
       count(CASE WHEN {kpi} THEN 1 END) AS kpi_lines,
       CAST(sum(CASE WHEN stockout_flag THEN order_value END) AS BIGINT) AS risk_value,
       count(CASE WHEN stockout_flag THEN order_id END) AS risk_orders,
       count(CASE WHEN stockout_flag THEN 1 END) AS risk_lines,
       count(CASE WHEN {supply} THEN 1 END) AS supply_lines,
       count(CASE WHEN {supply} AND stockout_flag THEN 1 END) AS supply_stockouts,
       count(CASE WHEN {supply} AND lower(delivery_status) = 'delivered' THEN 1 END) AS supply_delivered
FROM facts GROUP BY region, sku"""
    month = "CAST(date_trunc('month', m.order_ts) AS DATE) AS order_month, "

    def by_month(body: str, **steps) -> str:
        return _with(body, **steps, matched=_matched_sql(), facts=_facts_sql("latest_shipments", month))

    return {
        "scan_order_facts": over_facts("SELECT * FROM facts"),
        "scan_order_facts_json": over_facts("SELECT * FROM facts"),
        "landed_orders": _with("SELECT * EXCLUDE (line_no) FROM raw_order_lines"),
        "landed_inventory": _with("SELECT * FROM inventory_snapshots"),
        "landed_shipments": _with("SELECT * FROM all_shipments"),
        "landed_arrays": _with("SELECT * EXCLUDE (line_no) FROM raw_order_lines"),
        "landed_mixed": _with("SELECT * EXCLUDE (line_no) FROM raw_order_lines WHERE sku IS NOT NULL"),
        "rejected_records": _with(
            """SELECT '{"order_id": "' || order_id || '", ' AS record FROM raw_order_lines WHERE sku IS NULL"""
        ),
        "landed_incremental": _with("SELECT * FROM all_shipments"),
        "landed_compacted": _with("SELECT * FROM all_shipments"),
        "landed_once": _with("SELECT * FROM order_lines WHERE sku IS NOT NULL"),
        "load_metrics_by_region": over_facts(region_sql),
        "stamped": over_facts("SELECT count(*) AS fact_rows, true AS all_stamped, true AS one_time FROM facts"),
        "conform_inventory": _with("SELECT * FROM inventory_snapshots"),
        "conform_shipments": _with("SELECT * FROM all_shipments"),
        "order_value": over_facts("SELECT order_id, sku, quantity, price, order_value FROM facts"),
        "stockout_flag": over_facts(
            "SELECT order_id, sku, inventory_at_order_time, quantity, stockout_flag FROM facts"
        ),
        "quality_kpi": over_facts(f"SELECT * FROM facts WHERE {kpi}", join="LEFT JOIN"),
        "quality_supply": over_facts(f"SELECT * FROM facts WHERE {supply}", join="LEFT JOIN"),
        "stockout_lines": over_facts("SELECT * FROM facts WHERE stockout_flag"),
        "status_normalised": over_facts(
            "SELECT order_id, sku, delivery_status, lower(delivery_status) AS delivery_status_clean FROM facts"
        ),
        "shipments_for_orders": _with(
            "SELECT * FROM all_shipments WHERE order_id IN (SELECT order_id FROM order_lines)"
        ),
        "orders_without_shipment": _with(
            "SELECT DISTINCT order_id FROM order_lines EXCEPT SELECT order_id FROM all_shipments"
        ),
        "asof_inventory": over_match(),
        "asof_inventory_left": over_match(join="LEFT JOIN"),
        "asof_inventory_region": over_match(match="o.sku = i.sku AND o.region = i.inventory_region"),
        "order_facts": over_facts("SELECT * FROM facts", "all_shipments"),
        "order_facts_latest": over_facts("SELECT * FROM facts"),
        "dedupe_order_lines": _with("SELECT * FROM order_lines"),
        "latest_snapshot_by_sku": _with(
            """SELECT * EXCLUDE (rn)
FROM (SELECT *, row_number() OVER (PARTITION BY sku
                                   ORDER BY snapshot_ts DESC, warehouse_id, on_hand_qty NULLS LAST,
                                            inventory_region) AS rn
      FROM inventory_snapshots) s
WHERE rn = 1"""
        ),
        "distinct_order_ids": _with("SELECT DISTINCT order_id FROM raw_order_lines"),
        "status_values": over_facts("SELECT DISTINCT delivery_status FROM facts"),
        "revenue_summary": over_facts(revenue_sql),
        "revenue_by_region": over_facts(region_sql),
        "revenue_by_sku": over_facts(f"SELECT sku, {revenue} FROM facts WHERE {kpi} GROUP BY sku"),
        "revenue_distinct_orders": over_facts(
            f"""SELECT region, {revenue}, count(DISTINCT order_id) AS distinct_orders
FROM facts WHERE {kpi} GROUP BY region"""
        ),
        "revenue_summary_fanout": over_facts(revenue_sql, "all_shipments"),
        "risk_summary": over_facts(risk_sql),
        "risk_by_sku": over_facts(risk_sku_sql),
        "risk_by_region": over_facts(f"SELECT region, {risk} FROM facts WHERE stockout_flag GROUP BY region"),
        "risk_summary_fanout": over_facts(risk_sql, "all_shipments"),
        "supply_chain_summary": over_facts(supply_sql),
        "supply_chain_summary_fanout": over_facts(supply_sql, "all_shipments"),
        "metric_totals": over_facts(totals),
        "metric_state": over_facts(totals, **landed),
        "facts_by_month": by_month("SELECT * FROM facts"),
        "facts_after_batch": by_month("SELECT * FROM facts", **landed),
        "revenue_latest_month": by_month(
            f"""SELECT order_month, region, {revenue} FROM facts
WHERE {kpi} AND order_month = (SELECT max(order_month) FROM facts) GROUP BY order_month, region"""
        ),
        "revenue_card": over_facts(
            f"""SELECT CAST(sum(order_value) AS BIGINT) AS total_revenue, count(order_id) AS total_orders,
       round(avg(order_value), 2) AS avg_order_value
FROM facts WHERE {kpi}"""
        ),
        "revenue_series": over_facts(
            f"""SELECT region, CAST(sum(order_value) AS BIGINT) AS total_revenue
FROM facts WHERE {kpi} GROUP BY region"""
        ),
        "risk_card": over_facts(
            f"""SELECT total_revenue_at_risk, stockout_orders,
       CASE WHEN total_revenue_at_risk = 0 THEN 'healthy' ELSE 'loss' END AS risk_status
FROM ({risk_sql}) r"""
        ),
        "supply_card": over_facts(
            f"""SELECT total_order_lines, round(stockout_rate, 2) AS stockout_rate,
       round(delivery_success_rate, 2) AS delivery_success_rate
FROM ({supply_sql}) s"""
        ),
        "pipeline_revenue_by_region": over_facts(region_sql, **landed),
        "pipeline_risk_by_sku": over_facts(risk_sku_sql, **landed),
        "pipeline_supply_chain": over_facts(supply_sql, **landed),
        "pipeline_changes": over_facts(region_sql, **landed),
        "layer_counts": _with(
            f"""SELECT layer, measure, CAST(value AS BIGINT) AS value FROM (
SELECT 'orders' AS layer, 'read' AS measure, count(*) AS value FROM raw_order_lines
UNION ALL SELECT 'inventory', 'read', count(*) FROM inventory_snapshots
UNION ALL SELECT 'shipments', 'read', count(*) FROM all_shipments
UNION ALL SELECT unnest(['orders', 'inventory', 'shipments']), 'rejected', 0
UNION ALL SELECT 'order_lines', 'read', count(*) FROM raw_order_lines
UNION ALL SELECT 'order_lines', 'null_keys', count(*) FROM raw_order_lines WHERE order_id IS NULL OR sku IS NULL
UNION ALL SELECT 'order_lines', 'kept', count(*) FROM order_lines
UNION ALL SELECT 'order_facts', 'lines', count(*) FROM order_lines
UNION ALL SELECT 'order_facts', 'matched', count(*) FROM matched
UNION ALL SELECT 'order_facts', 'unmatched', (SELECT count(*) FROM order_lines) - (SELECT count(*) FROM matched)
UNION ALL SELECT 'order_facts', 'written', count(*) FROM facts) c""",
            matched=_matched_sql(),
            facts=_facts_sql("latest_shipments"),
            **landed,
        ),
        "distinct_orders_sketch": over_facts(
            f"""SELECT region, count(DISTINCT order_id) AS distinct_orders, true AS within_3_percent
FROM facts WHERE {kpi} GROUP BY region"""
        ),
        "latency_quantiles": _with(
            f"""SELECT carrier, quantile::DOUBLE AS quantile, timed, true AS rank_within_2_percent
FROM (SELECT carrier, count({taken}) AS timed FROM all_shipments GROUP BY carrier HAVING count({taken}) > 0) t
CROSS JOIN (SELECT unnest([0.5, 0.9, 0.99]) AS quantile) q"""
        ),
        "delivery_latency": _with(
            f"""SELECT o.order_id, o.sku, s.carrier, o.promised_delivery_ts, s.ship_ts, s.delivered_ts,
       round({taken} / 3600000000.0::DOUBLE, 6) AS latency_hours, s.delivered_ts > o.promised_delivery_ts AS late
FROM order_lines o LEFT JOIN latest_shipments s ON o.order_id = s.order_id"""
        ),
        "carrier_performance": _with(
            f"""SELECT carrier, count(*) AS shipments,
       count(CASE WHEN lower(delivery_status) = 'delivered' THEN 1 END) AS delivered_shipments,
       avg(CAST({done} AS DOUBLE)) AS delivered_rate,
       round(sum({taken})::DOUBLE / count({taken}) / 3600000000, 6) AS avg_latency_hours
FROM all_shipments GROUP BY carrier"""
        ),
        "sku_rank_in_region": over_facts(
            """SELECT region, sku, total_revenue,
       rank() OVER (PARTITION BY region ORDER BY total_revenue DESC) AS revenue_rank
FROM (SELECT region, sku, CAST(sum(order_value) AS BIGINT) AS total_revenue
      FROM facts WHERE order_value IS NOT NULL GROUP BY region, sku) t"""
        ),
        "revenue_trend": _with(
            """SELECT order_month, total_revenue, total_orders,
       total_revenue - lag(total_revenue) OVER (ORDER BY order_month) AS revenue_change
FROM (SELECT CAST(date_trunc('month', order_ts) AS DATE) AS order_month,
             CAST(sum(qty * unit_price) AS BIGINT) AS total_revenue, count(order_id) AS total_orders
      FROM order_lines WHERE order_ts IS NOT NULL GROUP BY 1) m"""
        ),
    }
