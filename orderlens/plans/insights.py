"""Delivery and revenue reports over order lines, shipments and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.functions import (
    MICROSECONDS_AN_HOUR,
    hours_between,
    is_delivered,
    microseconds_between,
    order_value,
    ratio,
)
from orderlens.operators.shipments import attach_shipments

BANDS = 100_000


def delivery_latency(lines: DataFrame, shipments: DataFrame) -> DataFrame:
    """Per order line: hours from shipping to delivery of its latest shipment, and whether that was late."""
    return attach_shipments(lines, shipments, "latest").select(
        "order_id",
        "sku",
        "carrier",
        "promised_delivery_ts",
        "ship_ts",
        "delivered_ts",
        hours_between("ship_ts", "delivered_ts").alias("latency_hours"),
        (F.col("delivered_ts") > F.col("promised_delivery_ts")).alias("late"),
    )


def carrier_performance(shipments: DataFrame) -> DataFrame:
    """Per carrier: shipments, delivered rate and average hours to deliver.

    Times are summed as whole microseconds and divided once, so the average is the same in any order of the rows. The sum
    is a decimal: a million shipments of some weeks are more microseconds than a bigint holds.
    """
    taken = microseconds_between("ship_ts", "delivered_ts")
    totals = shipments.groupBy("carrier").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count_if(is_delivered()).alias("delivered_shipments"),
        F.sum(taken.cast("decimal(19,0)")).alias("_taken"),
        F.count(taken).alias("_timed"),
    )
    return totals.select(
        "carrier",
        "shipments",
        "delivered_shipments",
        ratio(F.col("delivered_shipments"), F.col("shipments")).alias("delivered_rate"),
        F.round(ratio(F.col("_taken"), F.col("_timed")) / MICROSECONDS_AN_HOUR, 6).alias("avg_latency_hours"),
    )


def sku_rank_in_region(totals: DataFrame) -> DataFrame:
    """Revenue rank of every SKU within its region, the highest first, equal revenue on equal rank.

    `totals` has one row per region and SKU (`revenue(facts, "region", "sku")`) and is read three times, so
    give a written table. Ranking a region in one window would bring its whole catalogue into one task.
    Instead SKUs are counted per distinct revenue, those counts are summed per revenue band, and a rank is the
    count above the band plus the count above within it. Bands are 1/BANDS wide on a log scale: a region has
    4.4 million at most on either side of nought, and a band no more distinct values than 1/BANDS of the revenue it stands for.
    """
    revenue = totals.where("total_revenue IS NOT NULL").select("region", "sku", "total_revenue")
    value = F.col("total_revenue")
    band = (F.signum(value) * F.floor(F.log1p(F.abs(value).cast("double")) * BANDS)).cast("bigint")
    levels = (
        revenue.groupBy("region", "total_revenue")
        .agg(F.count(F.lit(1)).alias("_skus"))
        .withColumn("_band", band)
    )

    def above(*group: str, order: str):
        window = Window.partitionBy(*group).orderBy(F.desc(order))
        return F.coalesce(
            F.sum("_skus").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    bands = (
        levels.groupBy("region", "_band")
        .agg(F.sum("_skus").alias("_skus"))
        .select(
            F.col("region").alias("_region"), "_band", above("region", order="_band").alias("_before")
        )
    )
    ranked = levels.withColumn("_inside", above("region", "_band", order="total_revenue")).alias("l")
    ranks = ranked.join(
        bands.alias("b"),
        F.col("l.region").eqNullSafe(F.col("b._region")) & (F.col("l._band") == F.col("b._band")),
    ).select(
        F.col("region").alias("_region"),
        F.col("total_revenue").alias("_revenue"),
        (F.col("_before") + F.col("_inside") + 1).alias("revenue_rank"),
    )
    return revenue.join(
        ranks, F.col("region").eqNullSafe(F.col("_region")) & (value == F.col("_revenue"))
    ).select("region", "sku", "total_revenue", "revenue_rank")


def revenue_trend(lines: DataFrame) -> DataFrame:
    """Revenue per order month and its change from the month before.

    The window holds one row per month, whatever the number of lines.
    """
    months = (
        lines.where("order_ts IS NOT NULL")
        .groupBy(F.trunc(F.col("order_ts").cast("date"), "month").alias("order_month"))
        .agg(F.sum(order_value()).alias("total_revenue"), F.count("order_id").alias("total_orders"))
    )
    previous = F.lag("total_revenue").over(Window.orderBy("order_month"))
    return months.withColumn("revenue_change", F.col("total_revenue") - previous)
