"""What the operators share: written intermediate tables, words, packed integer columns."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderlens.sources import shared_dir

# The characters that separate words.
SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"
# Spark's setting that removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(df: DataFrame, name: str) -> str:
    """A new folder in the folder that all executors see."""
    spark = df.sparkSession
    return f"{shared_dir(spark)}/orderlens-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written once in the shared folder and read back.

    It cuts the lineage: a lost executor costs no more than the step that was running, and steps that are not
    the same when run again (row order, partition numbers) are run once. The shuffles behind it are not needed any
    more and go when it stands.
    """
    path, conf = scratch(df, name), df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def planes(values: np.ndarray) -> bytes:
    """Integers as byte planes: the high bytes of small numbers lie together and compress to nothing."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    kind = np.dtype(dtype)
    flat = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).reshape(-1)


def give_back() -> None:
    """Hands memory that is not in use back to the system: worker processes stay for later tasks, and keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def sparing(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same work on batches, which hands its memory back when a task ends."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def sparing_group(work: Callable):
    """The same work on one group, which hands its memory back when it is done."""

    def run(rows):
        try:
            return work(rows)
        finally:
            give_back()

    return run


def sparing_pair(work: Callable):
    """The same work on two co-grouped frames, which hands its memory back when it is done."""

    def run(left, right):
        try:
            return work(left, right)
        finally:
            give_back()

    return run


def of_process(name: str, make: Callable[[], object]):
    """One object for all tasks of a worker process. This package is shipped with each task, so its own globals are new each time."""
    held = sys.modules.setdefault("orderlens_process", types.ModuleType("orderlens_process")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]
