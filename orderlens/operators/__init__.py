from orderlens.operators.asof import asof_join
from orderlens.operators.quality import dedupe, latest_by, normalise_status, require, stockouts
from orderlens.operators.shipments import (
    attach_shipments,
    latest_shipments,
    order_ids,
    orders_without_shipment,
    shipments_for,
    status_values,
)

__all__ = [
    "asof_join",
    "attach_shipments",
    "dedupe",
    "latest_by",
    "latest_shipments",
    "normalise_status",
    "order_ids",
    "orders_without_shipment",
    "require",
    "shipments_for",
    "status_values",
    "stockouts",
]
