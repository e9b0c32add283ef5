"""Joins between orders and their shipments, and the small sets derived from either."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlens.functions import is_delivered
from orderlens.operators.quality import latest_by


def order_ids(orders: DataFrame) -> DataFrame:
    return orders.select("order_id").distinct()


def status_values(df: DataFrame) -> DataFrame:
    return df.select("delivery_status").distinct()


def shipments_for(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Shipments of the given orders, each once however many lines the order has."""
    return shipments.join(order_ids(orders), "order_id", "left_semi")


def orders_without_shipment(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Order ids still to be looked up. Both sides are reduced to distinct ids before they meet."""
    return order_ids(orders).join(order_ids(shipments), "order_id", "left_anti")


def latest_shipments(shipments: DataFrame) -> DataFrame:
    """The last shipment of every order. At equal times a delivered one wins, in whatever case its status is
    written, then the later delivery, then the other columns."""
    return latest_by(
        shipments,
        ["order_id"],
        [
            F.col("ship_ts").desc_nulls_last(),
            is_delivered().desc_nulls_last(),
            F.col("delivered_ts").desc_nulls_last(),
            F.col("delivery_status").asc_nulls_last(),
            F.col("carrier").asc_nulls_last(),
        ],
    )


SHIPMENT_COLUMNS = ("carrier", "ship_ts", "delivered_ts", "delivery_status")


def attach_shipments(lines: DataFrame, shipments: DataFrame, policy: str = "latest") -> DataFrame:
    """Left join of order lines to shipments.

    "latest" keeps one row per line, "all" repeats a line for each shipment of its order, and "none" leaves the
    shipment columns empty for measures that need none of them. No strategy is forced: Spark broadcasts a side it
    measures as small, and otherwise AQE splits an oversized order. In an outer join it can split the preserved
    side only, which serves "latest", whose right side has one row per order. With "all" an order may be oversized
    in shipments too, so matched lines come from an inner join, where either side can be split, and the others
    from an anti join on distinct ids. Both read one shuffle of the lines: their key is never null, so neither
    join adds a filter of its own, and lines without an id are told apart by their content.
    """
    if policy not in ("latest", "all", "none"):
        raise ValueError(f"unknown shipment policy: {policy}")
    right = shipments.select("order_id", *SHIPMENT_COLUMNS)
    if policy == "none":
        return lines.withColumns(
            {c: F.lit(None).cast(right.schema[c].dataType) for c in SHIPMENT_COLUMNS}
        )
    if policy == "latest":
        return lines.join(latest_shipments(right), "order_id", "left")
    known = right.where("order_id IS NOT NULL").withColumn("_order", F.concat(F.lit("="), "order_id"))
    apart = F.concat(F.lit("-"), F.xxhash64(*lines.columns).cast("string"))
    left = lines.withColumn("_order", F.coalesce(F.concat(F.lit("="), "order_id"), apart))
    matched = left.join(known.drop("order_id"), "_order")
    others = left.join(known.select("_order").distinct(), "_order", "left_anti")
    return matched.unionByName(others, allowMissingColumns=True).drop("_order")
