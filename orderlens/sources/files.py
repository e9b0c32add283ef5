"""Small things done on any file system Spark knows: listing, pointers, removal."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

DONE = "_SUCCESS"


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _open(spark, path)
    return fs.exists(at)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job wrote this folder to its end."""
    return exists(spark, f"{path}/{DONE}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it is not there."""
    at, fs = _open(spark, path)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory())


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and bytes of the data files right in a folder."""
    at, fs = _open(spark, path)
    found = {s.getPath().getName(): s.getLen() for s in fs.listStatus(at) if s.isFile()}
    return {name: size for name, size in found.items() if name[0] not in "._"}


def move(spark: SparkSession, path: str, target: str) -> None:
    """Renames a file or a folder; the target must not be there."""
    at, fs = _open(spark, path)
    to, _ = _open(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"cannot move {path} to {target}")


def matching(spark: SparkSession, path: str) -> list[str]:
    """The folders that a path or glob names."""
    at, fs = _open(spark, path)
    return [s.getPath().toString() for s in fs.globStatus(at) or [] if s.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _open(spark, path)
    fs.delete(at, True)


def put_pointer(spark: SparkSession, path: str, value) -> None:
    """Replaces a small JSON file in one step: a reader finds the old value or the new one."""
    jvm = spark.sparkContext._jvm
    aside, fs = _open(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()
    at, _ = _open(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    renaming = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    modes = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    modes[0] = renaming
    context.rename(aside, at, modes)


def pointer(spark: SparkSession, path: str, default=None):
    """The value of a pointer file, or the default where none was put."""
    at, fs = _open(spark, path)
    if not fs.exists(at):
        return default
    stream = fs.open(at)
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()
