"""WARC archives: written, normalised and read back.

A task writes its pages as one archive that is a single gzip stream, as many tools leave them. The normaliser inflates
such a stream once, record by record in bounded memory, rewrites each record as a gzip member of its own, and writes a
sidecar index of offsets beside it. Reading goes through the index: seek, inflate one member.

Of pages with equal payloads the one with the smallest id is a response, the others revisit it; payloads below
`min_bytes` are all responses. Null html is an empty payload; a null url is left out of the record's header; a null id
comes after all others. Rows that repeat the smallest id are responses too. An empty table gives no archive. Other
columns stay out. Archives carry unique names and count only if their task's result does, so a task that is run again
leaves nothing wrong behind. The folder is any that `pyarrow.fs` opens from a URI.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import written

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD_DATE = "1970-01-01T00:00:00Z"
CHUNK = 1 << 20
FAST, TIGHT = 1, 5


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}').urn}>"


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One record; `refers_to` makes it a revisit, which carries the head and no payload."""
    digest = _digest(payload)
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Bytes", len(payload)),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        head.append(("X-Page-ID", page_id))
    if refers_to is not None:
        head += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("X-Refers-To-Page", refers_to),
        ]
    block = HTTP_HEAD + (payload if refers_to is None else b"")
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return "".join([f"{VERSION}\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode() + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to).

    Equal payloads are found by digest on ids alone; the smallest id of a digest leaves each map task once. Pages
    and revisits meet on (page, digest), which no group of copies makes large. The revisits are a written table of
    known size: where it is small Spark broadcasts it and no payload is shuffled.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    ids = rows.filter(F.octet_length("payload") >= min_bytes).select("page_id", "digest")
    firsts = ids.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = (
        ids.join(firsts, "digest")
        .filter("first IS NOT NULL AND NOT (page_id <=> first)")
        .select(F.col("digest").alias("__digest"), F.col("page_id").alias("__page"), F.col("first").alias("refers_to"))
        .distinct()
    )
    revisits = written(revisits, "warc-revisits")
    same = F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("digest") == F.col("__digest"))
    return rows.join(revisits, same, "left").select("page_id", "url", "payload", "refers_to")


_PATH = StructType([StructField("path", StringType())])


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """(path): one archive per partition, a single gzip stream."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = sink = deflate = None
        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    files, place = _open(path)
                    files.create_dir(place.rpartition("/")[0], recursive=True)
                    sink = files.open_output_stream(place, compression=None)
                    deflate = zlib.compressobj(FAST, zlib.DEFLATED, 31)
                data = record(row["page_id"], row["url"], row["payload"], row["refers_to"])
                sink.write(deflate.compress(data))
        if sink is not None:
            sink.write(deflate.flush())
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [path]}, schema=to_arrow_schema(_PATH))

    return rows.mapInArrow(write, _PATH)


def _head(stream) -> dict[str, str] | None:
    """The header of the next record, with its bytes under the empty key; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    raw, head = [line], {}
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise EOFError("the stream ends inside a header")
        raw.append(line)
        name, _, value = line.decode("utf-8", "replace").partition(":")
        head[name.strip().lower()] = value.strip()
    head[""] = b"".join(raw) + b"\r\n"
    return head


def normalise_stream(source, sink, index) -> int:
    """Rewrites every record of a gzip stream as its own member; returns how many. Both sinks take bytes."""
    at = n = 0
    with gzip.GzipFile(fileobj=source, mode="rb") as stream:
        while (head := _head(stream)) is not None:
            deflate = zlib.compressobj(TIGHT, zlib.DEFLATED, 31)
            size = 0
            left = int(head["content-length"])
            parts = [head[""]]
            while parts:
                out = deflate.compress(parts.pop())
                sink.write(out)
                size += len(out)
                if left:
                    data = stream.read(min(left, CHUNK))
                    if not data:
                        raise EOFError("the stream ends inside a record")
                    left -= len(data)
                    parts.append(data)
            out = deflate.compress(b"\r\n\r\n") + deflate.flush()
            sink.write(out)
            size += len(out)
            line = {"offset": at, "length": size, "id": head.get("warc-record-id"), "type": head.get("warc-type")}
            index.write(json.dumps(line).encode() + b"\n")
            at, n = at + size, n + 1
    return n


def normalise(paths: DataFrame) -> DataFrame:
    """(path) of the rewritten archives; the index lies beside each as `path + ".idx"`."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for path in batch.column(0).to_pylist():
                target = f"{path.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.members.warc.gz"
                files, place = _open(path)
                to = _open(target)[1]
                with (
                    files.open_input_stream(place, compression=None, buffer_size=CHUNK) as source,
                    files.open_output_stream(to, compression=None, buffer_size=CHUNK) as sink,
                    files.open_output_stream(f"{to}.idx", compression=None, buffer_size=CHUNK) as index,
                ):
                    normalise_stream(source, sink, index)
                made.append(target)
            yield pa.RecordBatch.from_pydict({"path": made}, schema=to_arrow_schema(_PATH))

    return paths.mapInArrow(rewrite, _PATH)


def member(archive, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Header and block of the record at a place of the index."""
    archive.seek(offset)
    data = gzip.decompress(archive.read(length))
    end = data.index(b"\r\n\r\n") + 4
    head = dict(line.split(": ", 1) for line in data[:end].decode().split("\r\n")[1:] if line)
    return head, data[end : end + int(head["Content-Length"])]


_READ = StructType(
    [
        StructField("page", StringType()),
        StructField("payload_bytes", LongType()),
        StructField("payload_digest", StringType()),
        StructField("record_type", StringType()),
        StructField("refers", StringType()),
    ]
)
ROWS = 2000


def read_archives(paths: DataFrame) -> DataFrame:
    """One row per record, read through the index; a response's payload is hashed again and must fit its header."""

    def told(archive, place: dict) -> tuple:
        head, block = member(archive, place["offset"], place["length"])
        digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Bytes"])
        if head["WARC-Type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            if (_digest(payload), len(payload)) != (digest, size):
                raise ValueError(f"{head['WARC-Record-ID']}: the payload differs from its header")
        return head.get("X-Page-ID"), size, digest, head["WARC-Type"], head.get("X-Refers-To-Page")

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(zip(*rows), to_arrow_schema(_READ))], schema=to_arrow_schema(_READ)
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, place = _open(path)
                rows = []
                with files.open_input_file(place) as archive, files.open_input_file(f"{place}.idx") as index:
                    for line in index.read().splitlines():
                        rows.append(told(archive, json.loads(line)))
                        if len(rows) == ROWS:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    return paths.mapInArrow(read, _READ)


def round_trip(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes, normalises and reads back; what each page's record says."""
    paths = write_archives(with_revisits(pages, min_bytes), folder)
    kind = pages.schema["page_id"].dataType
    return read_archives(normalise(paths)).select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers").cast(kind).alias("refers_to"),
    )


def oracle_sql(min_bytes: int = 0) -> str:
    """Everything but the base32 form of the digest, which SQL has no function for, comes from plain SQL."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    bits = "list_aggregate([lpad(bin(CAST('0x' || c AS INTEGER)), 4, '0') for c in string_split(sha1(html), '')], 'string_agg', '')"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS digest, {bits} AS bits FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, payload_bytes,
       list_aggregate([substr('{alphabet}', CAST(('0b' || substr(bits, CAST(5 * i + 1 AS BIGINT), 5)) AS INTEGER) + 1, 1)
                       for i in range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN payload_bytes >= {min_bytes} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {min_bytes} AND page_id <> first THEN first END AS refers_to
FROM f"""
