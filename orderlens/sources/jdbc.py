"""Extract of a database table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    partition_col: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int = 8,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Reader options for a full extract, split over `num_partitions` connections by a numeric, date or time column.

    The bounds only place the splits: rows outside them, and nulls, are read by the first or last split.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if partition_col is not None:
        if bounds is None:
            raise ValueError("a partition column needs its bounds")
        low, high = bounds
        options |= {
            "partitionColumn": partition_col,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    partition_col: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int = 8,
    **properties: str,
) -> DataFrame:
    """The whole table as of now. Zone-less times stay zone-less."""
    options = jdbc_options(url, table, partition_col, bounds, num_partitions, **properties)
    return spark.read.format("jdbc").options(preferTimestampNTZ="true", **options).load()
