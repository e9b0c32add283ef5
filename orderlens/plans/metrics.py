"""Metric datasets over the fact table.

`revenue`, `revenue_at_risk` and `supply_chain` each compute one dataset. `all_metrics` computes the seven of a
full run from one pass: every measure is a whole-number sum or count, so the totals per region and SKU add up
to each of them. Averages and rates are exact sums divided once, hence the same on any partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlens.functions import is_delivered, ratio
from orderlens.operators.quality import (
    KPI_COLUMNS,
    SUPPLY_COLUMNS,
    normalise_status,
    present,
    require,
    stockouts,
)

GROUPINGS = {"summary": (), "by_region": ("region",), "by_sku": ("sku",)}


def _or_zero(column):
    return F.coalesce(column, F.lit(0).cast("bigint"))


def revenue(facts: DataFrame, *by: str, distinct_orders: bool = False) -> DataFrame:
    """Revenue, order lines (`total_orders` counts fact rows) and average value, overall or per group.

    `distinct_orders` adds the number of different orders. It shuffles every (group, order) pair, which the
    other measures do not, so it has to be asked for.
    """
    measures = [
        F.sum("order_value").alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
    ]
    if distinct_orders:
        measures.append(F.count_distinct("order_id").alias("distinct_orders"))
    totals = require(facts, *KPI_COLUMNS).groupBy(*by).agg(*measures)
    return totals.withColumn(
        "avg_order_value", ratio(F.col("total_revenue"), F.col("total_orders"))
    )


def revenue_at_risk(facts: DataFrame, *by: str) -> DataFrame:
    """Value and number of the lines ordered beyond the stock."""
    return (
        stockouts(facts)
        .groupBy(*by)
        .agg(
            _or_zero(F.sum("order_value")).alias("total_revenue_at_risk"),
            F.count("order_id").alias("stockout_orders"),
        )
    )


def supply_chain(facts: DataFrame) -> DataFrame:
    """Stockout and delivery rates over lines with a warehouse. An unknown flag counts as not stocked out."""
    lines = normalise_status(require(facts, *SUPPLY_COLUMNS))
    totals = lines.agg(
        F.count("order_id").alias("total_order_lines"),
        F.count_if("stockout_flag").alias("stockout_order_lines"),
        F.count_if(F.col("delivery_status_clean") == "delivered").alias("delivered_order_lines"),
    )
    return _with_rates(totals)


def _with_rates(totals: DataFrame) -> DataFrame:
    lines = F.col("total_order_lines")
    return totals.withColumns(
        {
            "stockout_rate": ratio(F.col("stockout_order_lines"), lines),
            "delivery_success_rate": ratio(F.col("delivered_order_lines"), lines),
        }
    )


def revenue_kpis(facts: DataFrame) -> dict[str, DataFrame]:
    return {f"revenue_kpis/{name}": revenue(facts, *by) for name, by in GROUPINGS.items()}


def risk_metrics(facts: DataFrame) -> dict[str, DataFrame]:
    return {f"revenue_at_risk/{name}": revenue_at_risk(facts, *by) for name, by in GROUPINGS.items()}


def supply_metrics(facts: DataFrame) -> dict[str, DataFrame]:
    return {"supply_chain_metrics/summary": supply_chain(facts)}


def metric_totals(facts: DataFrame) -> DataFrame:
    """All additive measures per region and SKU, each under its own row filter: one scan, one shuffle.

    Rows leave the map tasks pre-aggregated, so a region or SKU with a third of the facts is no hot spot.
    """
    kpi, supply = present(*KPI_COLUMNS), present(*SUPPLY_COLUMNS)
    short = F.col("stockout_flag")
    return facts.groupBy("region", "sku").agg(
        F.sum(F.when(kpi, F.col("order_value"))).alias("kpi_value"),
        F.count_if(kpi).alias("kpi_lines"),
        F.sum(F.when(short, F.col("order_value"))).alias("risk_value"),
        F.count(F.when(short, F.col("order_id"))).alias("risk_orders"),
        F.count_if(short).alias("risk_lines"),
        F.count_if(supply).alias("supply_lines"),
        F.count_if(supply & short).alias("supply_stockouts"),
        F.count_if(supply & is_delivered()).alias("supply_delivered"),
    )


def all_metrics(totals: DataFrame) -> dict[str, DataFrame]:
    """The seven datasets from `metric_totals`, equal to those computed from the facts one by one."""
    datasets = {}
    for name, by in GROUPINGS.items():
        datasets[f"revenue_kpis/{name}"] = (
            totals.where("kpi_lines > 0")
            .groupBy(*by)
            .agg(
                F.sum("kpi_value").alias("total_revenue"),
                _or_zero(F.sum("kpi_lines")).alias("total_orders"),
            )
            .withColumn("avg_order_value", ratio(F.col("total_revenue"), F.col("total_orders")))
        )
        datasets[f"revenue_at_risk/{name}"] = (
            totals.where("risk_lines > 0")
            .groupBy(*by)
            .agg(
                _or_zero(F.sum("risk_value")).alias("total_revenue_at_risk"),
                _or_zero(F.sum("risk_orders")).alias("stockout_orders"),
            )
        )
    datasets["supply_chain_metrics/summary"] = _with_rates(
        totals.agg(
            _or_zero(F.sum("supply_lines")).alias("total_order_lines"),
            _or_zero(F.sum("supply_stockouts")).alias("stockout_order_lines"),
            _or_zero(F.sum("supply_delivered")).alias("delivered_order_lines"),
        )
    )
    return datasets
