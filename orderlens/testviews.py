"""The order model on the TPC-H-like tables: raw orders, stock snapshots and shipments (see FIXTURES.md B)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Declared, so that opening a table runs no job; only the columns the views use.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_discount double, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}

LINE_ORDER = ("line_no", "qty", "unit_price", "discount")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _labelled(prefix: str, column) -> Column:
    return F.concat(F.lit(prefix), column.cast("string"))


def _region_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("region")
    )


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with their line items, copies included; an order without any is a line without SKU.

    Line items meet their part and orders their customer first, while they are narrow. The two sides then meet by the order id
    itself, so that rows of one order lie together for whatever follows.
    """
    part = table(spark, sf_dir, "part")
    items = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount")
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            _labelled("ORD", F.col("l_orderkey")).alias("order_id"),
            _labelled("SKU", F.col("l_partkey")).alias("sku"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            F.floor("p_retailprice").cast("bigint").alias("unit_price"),
            F.round(F.col("l_discount") * 100).cast("bigint").alias("discount"),
            F.col("l_linenumber").alias("line_no"),
        )
    )
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_region_names(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _labelled("ORD", F.col("o_orderkey")).alias("order_id"),
            "o_orderkey",
            "o_orderdate",
            "o_custkey",
            "o_orderstatus",
            "region",
        )
    )
    return orders.join(items, "order_id", "left").select(
        "order_id",
        F.col("o_orderdate").alias("order_ts"),
        _labelled("CUST", F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderkey") % 2 == 0, "online").otherwise("store").alias("channel"),
        "region",
        "sku",
        "qty",
        "unit_price",
        "discount",
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(3))).alias("promised_delivery_ts"),
        F.col("o_orderstatus").alias("order_status"),
        "line_no",
    )


def line_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SKU of every line item: what the lines of a SKU are counted by, without joining them."""
    return table(spark, sf_dir, "lineitem").select(_labelled("SKU", F.col("l_partkey")).alias("sku"))


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as stock snapshots, under the raw column names.

    Suppliers and nations are joined one after the other, as Spark knows the size of a table but not that of a join, and
    would shuffle all line items for a few suppliers.
    """
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_region_names(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_shipdate").alias("snapshot_ts"),
            _labelled("W", F.col("l_suppkey")).alias("warehouse_id"),
            "region",
            _labelled("SKU", F.col("l_partkey")).alias("sku"),
            F.nullif(F.col("l_quantity").cast("bigint"), F.lit(50)).alias("on_hand_qty"),
        )
    )


def raw_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """None, one or two shipments per order, under the raw column names."""
    items = table(spark, sf_dir, "lineitem")
    key, done = F.col("l_orderkey"), F.col("l_linestatus") == "F"
    return (
        items.groupBy("l_orderkey", "l_linestatus")
        .agg(F.min("l_shipdate").alias("ship_ts"), F.max("l_shipdate").alias("_last"))
        .select(
            _labelled("ORD", key).alias("order_id"),
            F.when(key % 3 == 0, "UPS").when(key % 3 == 1, "FedEx").otherwise("USPS").alias("carrier"),
            "ship_ts",
            F.when(done, F.col("_last") + F.make_dt_interval(F.lit(2))).alias("delivered_ts"),
            F.when(done, "DELIVERED").otherwise("IN_TRANSIT").alias("status"),
        )
    )
