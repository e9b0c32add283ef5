"""Repeated ingestion: only files that arrived since the last run are parsed."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from orderlens.schemas import typed
from orderlens.sources.files import remove
from orderlens.sources.landing import SOURCE, landed_files, landed_schema, read_landing_json
from orderlens.sources.sinks import write_table
from orderlens.sources.tables import read_table
from orderlens.streaming.loads import LOAD, read_loads


# Keys of a stream lie on the executors' disks, within a fixed part of memory, and what a batch changes of them is
# written, not all of them.
_STATE = "spark.sql.streaming.stateStore"
STATE_ON_DISK = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start meanwhile keep their state so; a stream that goes on keeps the store it began with."""
    before = {name: spark.conf.get(name, None) for name in STATE_ON_DISK}
    for name, value in STATE_ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@dataclass(frozen=True)
class Once:
    """Which copies a stream leaves out: records with the keys of one that arrived up to `delay` before.

    Time is that of arrival, so no record is ever too late and none is lost for its own time. Keys are forgotten `delay` after
    they arrived, which bounds the state by the records of that span; a copy that comes later is kept and left to the
    fact job. Records without one of the keys are all kept, unreadable ones too.

    Of copies that differ the first one stays, and one left out is gone for good: not for landing areas where the batch
    with the first may be replaced.
    """

    keys: Sequence[str]
    delay: str


def convert_new_batches(
    spark: SparkSession,
    path: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    multi_line: bool = False,
    once: Once | None = None,
) -> StreamingQuery:
    """Adds every landed file not yet seen to a typed table as one load folder, exactly once, then stops.

    A load that is written again after a stop replaces itself. Every record keeps the name of its file: of a batch that was
    replaced the old files are gone, and `present_files` leaves their records out on reading, until `loads.compact` takes them
    off the disk. Unreadable records are kept in the table and told apart on reading (`good_records`, `bad_records`). The checkpoint
    folder remembers the files done; it must outlive the run, like the table. Without `once` the stream keeps no state: copies
    are removed by the fact job, where all copies of an order line meet.
    """
    records = typed(read_landing_json(spark, path, schema, multi_line, stream=True), schema)
    if once is not None:
        records = _once(records, once)

    def put(rows: DataFrame, number: int) -> None:
        # Asking first whether there are any would work the batch out twice, its state too.
        load = f"{table}/{LOAD}{number:09d}"
        write_table(rows, load)
        if read_table(rows.sparkSession, load, schema=rows.schema).isEmpty():
            remove(rows.sparkSession, load)

    stream = records.writeStream.foreachBatch(put).outputMode("append").option("checkpointLocation", checkpoint)
    with _state_on_disk(spark):
        return stream.trigger(availableNow=True).start()


def _once(records: DataFrame, once: Once) -> DataFrame:
    known = F.expr(" AND ".join(f"{c} IS NOT NULL" for c in once.keys))
    # A record that cannot be told apart by its keys gets a name of its own.
    marked = records.withColumns({"_alone": F.when(~known, F.uuid()), "_arrived": F.current_timestamp()})
    near = marked.withWatermark("_arrived", once.delay).dropDuplicatesWithinWatermark([*once.keys, "_alone"])
    return near.select(*records.columns)


def present_files(records: DataFrame, path: str) -> DataFrame:
    """The records whose files still stand in the landing area."""
    return records.join(landed_files(records.sparkSession, path), SOURCE, "left_semi").select(*records.columns)


def read_converted(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """All records that were converted, unreadable ones too."""
    return read_loads(spark, table, landed_schema(schema))
