"""Row filters and one-row-per-key reductions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

KPI_COLUMNS = ("order_id", "sku", "order_value")
SUPPLY_COLUMNS = ("order_id", "sku", "warehouse_id")


def present(*columns: str) -> Column:
    """True where every named column has a value; never null."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def require(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(present(*columns))


def stockouts(facts: DataFrame) -> DataFrame:
    """Lines known to exceed the stock; an unknown flag is left out."""
    return facts.where("stockout_flag")


def normalise_status(df: DataFrame) -> DataFrame:
    return df.withColumn("delivery_status_clean", F.lower("delivery_status"))


def latest_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order.

    Spark keeps one row per key in every map task before it shuffles (WindowGroupLimit), so a key with many
    rows arrives as one row per map task. Rows with null keys form a group, like any other key.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def dedupe(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per key. The order must decide between any two rows that differ; by default it takes every column."""
    if order_by is None:
        order_by = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return latest_by(df, keys, order_by)
