"""Raw orders, stock snapshots and shipments to one fact row per order line."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from orderlens.functions import order_value, stockout_flag
from orderlens.operators.asof import CELL_SECONDS, asof_join
from orderlens.operators.quality import dedupe
from orderlens.operators.shipments import SHIPMENT_COLUMNS, attach_shipments

LINE_KEYS = ("order_id", "sku")
# What facts are made of: the columns of a line, and of the snapshot that it finds.
LINE_COLUMNS = ("order_id", "order_ts", "sku", "customer_id", "qty", "unit_price", "region")
STOCK_COLUMNS = ("warehouse_id", "on_hand_qty")


@dataclass(frozen=True)
class Options:
    """How to build the facts.

    how: "inner" drops lines without an earlier snapshot, "left" keeps them.
    keys: ("sku",), or ("sku", "region") to match stock of the order's own region only.
    shipments: "latest" keeps one row per line, "all" one per line and shipment, "none" leaves them out.
    dedupe_order: which copy of a line wins; default is a sort over all columns.
    cell_seconds: cell length of the point-in-time join.
    """

    how: str = "inner"
    keys: Sequence[str] = ("sku",)
    shipments: str = "latest"
    dedupe_order: Sequence[Column | str] | None = None
    cell_seconds: int = CELL_SECONDS


def order_lines(orders: DataFrame, options: Options = Options()) -> DataFrame:
    return dedupe(orders, LINE_KEYS, options.dedupe_order)


def stock_by(inventory: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshots with the match keys under their order-side names."""
    keyed = inventory.withColumn("region", F.col("inventory_region")) if "region" in keys else inventory
    return keyed.select(*keys, "snapshot_ts", "warehouse_id", "on_hand_qty", "inventory_region")


def match_inventory(
    lines: DataFrame,
    inventory: DataFrame,
    options: Options = Options(),
    weighed: DataFrame | None = None,
    take: Sequence[str] | None = None,
) -> DataFrame:
    """Order lines with the newest snapshot known at the moment of the order.

    `weighed` may name a frame with the SKU of all raw lines: they are counted there, so that copies are removed once. `take`
    names the columns of the snapshot that are wanted.
    """
    return asof_join(
        lines,
        stock_by(inventory, options.keys),
        options.keys,
        "order_ts",
        "snapshot_ts",
        tie_break=["warehouse_id", "on_hand_qty"],
        how=options.how,
        cell_seconds=options.cell_seconds,
        weighed=weighed,
        take=take,
    )


def project_facts(
    matched: DataFrame, shipments: DataFrame, policy: str, more: Sequence[str] = ()
) -> DataFrame:
    """The fact columns, and any columns of the lines that are named besides."""
    return _fact_columns(attach_shipments(matched, shipments, policy), more)


def _fact_columns(rows: DataFrame, more: Sequence[str]) -> DataFrame:
    return rows.select(
        "order_id",
        "sku",
        "customer_id",
        F.col("qty").alias("quantity"),
        F.col("unit_price").alias("price"),
        order_value().alias("order_value"),
        F.col("on_hand_qty").alias("inventory_at_order_time"),
        stockout_flag().alias("stockout_flag"),
        "warehouse_id",
        "region",
        "delivery_status",
        "carrier",
        "ship_ts",
        "delivered_ts",
        *more,
    )


def build_order_facts(
    orders: DataFrame,
    inventory: DataFrame,
    shipments: DataFrame,
    options: Options = Options(),
    weighed: DataFrame | None = None,
) -> DataFrame:
    """The fact table, without its load time (see `stamp`). Inputs are conformed frames; `weighed` as in `match_inventory`."""
    return line_facts(order_lines(orders, options), inventory, shipments, options, weighed=weighed)


def line_facts(
    lines: DataFrame,
    inventory: DataFrame,
    shipments: DataFrame,
    options: Options = Options(),
    more: Sequence[str] = (),
    weighed: DataFrame | None = None,
    written: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Facts of lines without copies. The latest shipment is a row per line at most, so it is fetched while the lines of an
    order still lie together; every shipment repeats lines and comes last.

    `written` may write a step under a name and read it back: the lines, and where every shipment follows, the matched lines.
    The shuffles behind a step can then go before the next one makes its own, and the match, which reads the lines
    several times, works them out once. Only columns that facts are made of go into a step.
    """
    latest = options.shipments == "latest"
    shipped = attach_shipments(lines, shipments, "latest") if latest else lines
    needed = dict.fromkeys([*LINE_COLUMNS, *options.keys, *(SHIPMENT_COLUMNS if latest else ()), *more])
    asking = shipped.select(*needed)
    if written is not None:
        # Written lines are counted as they stand.
        asking, weighed = written(asking, "lines"), None
    matched = match_inventory(asking, inventory, options, weighed, STOCK_COLUMNS)
    if latest:
        return _fact_columns(matched, more)
    if written is not None and options.shipments == "all":
        matched = written(matched, "matched")
    return project_facts(matched, shipments, options.shipments, more)
