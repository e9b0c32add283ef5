"""The figures a report shows, as one-row frames over the metric datasets. Rounding is half up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _whole(name: str):
    return F.col(name).cast("bigint").alias(name)


def revenue_card(summary: DataFrame) -> DataFrame:
    return summary.select(
        _whole("total_revenue"),
        _whole("total_orders"),
        F.round("avg_order_value", 2).alias("avg_order_value"),
    )


def revenue_series(by_region: DataFrame) -> DataFrame:
    return by_region.select("region", "total_revenue")


def risk_card(summary: DataFrame) -> DataFrame:
    """Unknown figures, and figures the dataset does not carry, show as 0; a card always has its one row."""
    one = summary.agg(
        *[
            F.coalesce(
                F.max(name).cast("bigint") if name in summary.columns else F.lit(None).cast("bigint"),
                F.lit(0).cast("bigint"),
            ).alias(name)
            for name in ("total_revenue_at_risk", "stockout_orders")
        ]
    )
    return one.withColumn(
        "risk_status", F.when(F.col("total_revenue_at_risk") == 0, "healthy").otherwise("loss")
    )


def supply_card(summary: DataFrame) -> DataFrame:
    return summary.select(
        _whole("total_order_lines"),
        F.round("stockout_rate", 2).alias("stockout_rate"),
        F.round("delivery_success_rate", 2).alias("delivery_success_rate"),
    )
