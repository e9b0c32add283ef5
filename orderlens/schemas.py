"""Declared schemas, one per dataset, and the cast from landed text to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _schema(**fields) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


_text, _whole, _real, _flag = StringType(), LongType(), DoubleType(), BooleanType()
_time = TimestampNTZType()

ORDERS = _schema(
    order_id=_text,
    order_ts=_time,
    customer_id=_text,
    channel=_text,
    region=_text,
    sku=_text,
    qty=_whole,
    unit_price=_whole,
    discount=_whole,
    promised_delivery_ts=_time,
    order_status=_text,
)

INVENTORY = _schema(
    snapshot_ts=_time, warehouse_id=_text, region=_text, sku=_text, on_hand_qty=_whole
)

SHIPMENTS = _schema(
    order_id=_text, carrier=_text, ship_ts=_time, delivered_ts=_time, status=_text
)

ORDER_FACTS = _schema(
    order_id=_text,
    sku=_text,
    customer_id=_text,
    quantity=_whole,
    price=_whole,
    order_value=_whole,
    inventory_at_order_time=_whole,
    stockout_flag=_flag,
    warehouse_id=_text,
    region=_text,
    delivery_status=_text,
    carrier=_text,
    ship_ts=_time,
    delivered_ts=_time,
    ingestion_ts=TimestampType(),
)


def landing_schema(schema: StructType) -> StructType:
    """Every field as text: one value of the wrong type would taint all records of its document."""
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of `schema` in their types, text that does not parse as null, then all other columns."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cast = [
        F.col(f.name)
        if have.get(f.name) == f.dataType
        else F.col(f.name).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cast, *[c for c in df.columns if c not in schema.fieldNames()])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of `schema`; text that does not parse becomes null."""
    if [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]:
        return df
    return typed(df, schema).select(*schema.fieldNames())


def conform_orders(df: DataFrame) -> DataFrame:
    return conform(df, ORDERS)


def conform_inventory(df: DataFrame) -> DataFrame:
    """Stock snapshots; their region is renamed so that the order's region stays the only `region`."""
    return conform(df, INVENTORY).withColumnRenamed("region", "inventory_region")


def conform_shipments(df: DataFrame) -> DataFrame:
    return conform(df, SHIPMENTS).withColumnRenamed("status", "delivery_status")
