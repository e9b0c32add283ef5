"""Scans of written tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """A directory of Parquet parts, or of JSON lines (`fmt="json"`, which needs the schema).

    JSON leaves out null fields, so a column that is null throughout exists on re-read only by declaration.
    """
    if fmt == "json":
        if schema is None:
            raise ValueError("a JSON table needs a declared schema")
        return spark.read.schema(schema).json(path)
    if fmt != "parquet":
        raise ValueError(f"unknown table format: {fmt}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def load_metrics(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One metric dataset; a dataset that was never written raises."""
    return spark.read.parquet(f"{base}/{name}")


# Folders made for applications whose cluster names none.
_own_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in its settings or for its context.

    A run on one machine that names none gets one new local folder per application; a cluster has to name one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        named = _own_folders.get(app) or _own_folders.setdefault(app, tempfile.mkdtemp(prefix="orderlens-"))
    return named.rstrip("/")
