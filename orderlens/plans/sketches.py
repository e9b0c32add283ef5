"""Distinct orders and latency quantiles from sketches that merge.

A sketch is a few kilobytes whatever it has seen, combined in the map tasks, so one row per group is shuffled where exact
distinct counts shuffle every (group, order) pair and exact quantiles sort every value. Sketches of small groups add up to those of
larger ones: regions from (region, SKU), years from months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orderlens.functions import microseconds_between
from orderlens.operators.quality import KPI_COLUMNS, require

# 2^14 registers: a relative standard error of 0.8 %. Exact up to some hundred orders a group.
ORDER_BITS = 14
# Items kept per level: a rank error of 0.7 % at 99 % confidence.
LATENCY_ITEMS = 400
ORDERS, LATENCIES = "orders_sketch", "latency_sketch"


def order_sketches(facts: DataFrame, *by: str) -> DataFrame:
    """One sketch of the order ids per group, over the lines that revenue counts."""
    return require(facts, *KPI_COLUMNS).groupBy(*by).agg(F.hll_sketch_agg("order_id", ORDER_BITS).alias(ORDERS))


def merged_orders(sketches: DataFrame, *by: str) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*by).agg(F.hll_union_agg(ORDERS).alias(ORDERS))


def distinct_orders(sketches: DataFrame) -> DataFrame:
    """The estimated number of different orders in place of the sketch."""
    return sketches.select(
        *[c for c in sketches.columns if c != ORDERS], F.hll_sketch_estimate(ORDERS).alias("distinct_orders")
    )


def latency_sketches(shipments: DataFrame, *by: str) -> DataFrame:
    """One sketch of the whole microseconds from shipping to delivery per group, and how many there are."""
    taken = microseconds_between("ship_ts", "delivered_ts")
    timed = shipments.select(*by, taken.alias("_taken")).where("_taken IS NOT NULL")
    return timed.groupBy(*by).agg(
        F.expr(f"kll_sketch_agg_bigint(_taken, {LATENCY_ITEMS})").alias(LATENCIES), F.count(F.lit(1)).alias("timed")
    )


def merged_latencies(sketches: DataFrame, *by: str) -> DataFrame:
    merge = F.expr(f"kll_merge_agg_bigint({LATENCIES}, {LATENCY_ITEMS})")
    return sketches.groupBy(*by).agg(merge.alias(LATENCIES), F.sum("timed").alias("timed"))


def latency_quantiles(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """A row per group and quantile with the latency in whole microseconds."""
    found = [
        F.struct(
            F.lit(float(q)).alias("quantile"),
            F.expr(f"kll_sketch_get_quantile_bigint({LATENCIES}, {float(q)!r}D)").alias("latency_us"),
        )
        for q in quantiles
    ]
    return sketches.select(*[c for c in sketches.columns if c != LATENCIES], F.inline(F.array(*found)))
