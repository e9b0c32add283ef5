"""Landing batches, tables and metric datasets."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from orderlens.sources import files

# Names the files of a batch that was replaced.
CURRENT = "_current.json"
TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Spark's setting that removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Compressed text does not split, so a file of it holds at most so many records.
RECORDS_A_FILE = 1_000_000


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind: whoever reads the table needs them no more."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def times_as_text(df: DataFrame) -> DataFrame:
    """Every time column as ISO text in one fixed pattern, a zone-less time as it reads on the clock."""
    text = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):
            text[f.name] = F.date_format(f.name, TIME_TEXT)
        elif isinstance(f.dataType, TimestampNTZType):
            # Formatting would give it a zone first and move it across clock changes; its own text does not.
            parts = F.split(F.col(f.name).cast("string"), r"\.")
            fraction = F.rpad(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), 6, "0")
            text[f.name] = F.concat(F.translate(F.get(parts, F.lit(0)), " ", "T"), F.lit("."), fraction)
    return df.withColumns(text)


def land_batch(df: DataFrame, path: str, batch_id: str, fmt: str = "json", compression: str | None = None) -> str:
    """Adds one batch to a landing area as `<path>/batch_id=<id>/`, one file per task.

    Batches stand beside each other; writing a batch again replaces that batch, so a rerun lands no copies. It is written aside
    first and a pointer in the batch's folder then names its files, in one step: a run that stops in between leaves the
    old batch, and a reader sees one of both, never neither. Files that were replaced stay until the next replacement,
    for readers that have begun; `landing.stale_files` names them.

    With `compression="gzip"` JSON takes about a tenth of the space. Its files are cut at a million records, as they do not split.
    """
    if fmt not in ("json", "parquet"):
        raise ValueError(f"unknown landing format: {fmt}")
    if compression not in (None, "gzip"):
        raise ValueError(f"unknown compression: {compression}")
    spark, target = df.sparkSession, f"{path}/batch_id={batch_id}"
    landed = times_as_text(df) if fmt == "json" else df
    writer = landed.write.format(fmt)
    if compression is not None:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", RECORDS_A_FILE)
    if not files.exists(spark, target):
        with shuffles_removed(spark):
            writer.mode("overwrite").save(target)
        return target
    aside = f"{path}/.aside-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        writer.save(aside)
    here, pointer = files.data_files(spark, target), f"{target}/{CURRENT}"
    before = files.pointer(spark, pointer, sorted(here))
    files.put_pointer(spark, pointer, before)
    made = sorted(files.data_files(spark, aside))
    for name in made:
        files.move(spark, f"{aside}/{name}", f"{target}/{name}")
    files.put_pointer(spark, pointer, made)
    for name in here.keys() - set(before):
        files.remove(spark, f"{target}/{name}")
    files.remove(spark, aside)
    return target


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replaces a Parquet table. The path must not be one that `df` reads."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        writer.parquet(path)


def write_metrics(datasets: Mapping[str, DataFrame], base: str) -> None:
    for name, df in datasets.items():
        write_table(df, f"{base}/{name}")
