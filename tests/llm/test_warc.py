from __future__ import annotations

import gzip
import io
import json
import zlib

import pytest

from orderlens.llm import warc
from orderlens.llm.common import scratch
from support import same, sql_rows

PAGES = "page_id long, url string, html string, refers_to string, digest int"
ROWS = [
    (5, "http://a/1", "same", "x", 1),
    (3, "http://a/2", "same", "x", 1),
    (9, None, "same", "x", 1),
    (1, "http://a/\r\nX-Page-ID: 77", None, "x", 1),
    (2, "http://a/3", "", "x", 1),
    (4, "http://é/", "é\r\n\r\nWARC/1.1\r\n\x00", "x", 1),
    (6, "", "z" * 3_000_000, "x", 1),
    *[(100 + i, "http://hot/", "hot page", "x", 1) for i in range(300)],
]


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


@pytest.mark.parametrize("least", (0, 5))
def test_against_sql(spark, least):
    table = pages(spark, ROWS).repartition(3)
    same(warc.round_trip(table, scratch(table, "test-warc"), least), *sql_rows(warc.oracle_sql(least), pages=table))


def test_null_and_repeated_ids(spark):
    rows = [(None, "u", "p", "x", 1), (2, "u", "p", "x", 1), (2, "u", "p", "x", 1), (None, "u", "q", "x", 1), (2, "u", "r", "x", 1)]
    table = pages(spark, rows)
    got = sorted(repr((r.page_id, r.record_type, r.refers_to)) for r in warc.round_trip(table, scratch(table, "w")).collect())
    want = [(None, "revisit", 2), (2, "response", None), (2, "response", None), (None, "response", None), (2, "response", None)]
    assert got == sorted(map(repr, want))


def test_archives(spark):
    """The written file is one stream, the rewritten one has a member per record, and the index points at them."""
    table = pages(spark, ROWS).coalesce(1)
    paths = warc.write_archives(warc.with_revisits(table), scratch(table, "test-archives")).collect()
    records = 0
    for (path,) in paths:
        raw = open(path, "rb").read()
        inflate = zlib.decompressobj(31)
        whole = inflate.decompress(raw)
        assert inflate.eof and not inflate.unused_data
        again = warc.normalise(spark.createDataFrame([(path,)], "path string")).first().path
        data = open(again, "rb").read()
        assert gzip.decompress(data) == whole
        index = [json.loads(line) for line in open(f"{again}.idx")]
        records += len(index)
        assert [i["offset"] for i in index] == [sum(x["length"] for x in index[:k]) for k in range(len(index))]
        for place in index:
            one = gzip.decompress(data[place["offset"] : place["offset"] + place["length"]])
            assert one.startswith(b"WARC/1.1\r\n") and place["id"].encode() in one.split(b"\r\n\r\n")[0]
    assert records == len(ROWS)


def test_members_are_taken_as_they_are():
    one = warc.record(1, "http://a", b"x" * 100, None)
    first, second, index = io.BytesIO(), io.BytesIO(), io.BytesIO()
    assert warc.normalise_stream(io.BytesIO(gzip.compress(one) + gzip.compress(one * 2)), first, index) == 3
    assert warc.normalise_stream(io.BytesIO(first.getvalue()), second, io.BytesIO()) == 3
    assert second.getvalue() == first.getvalue()


@pytest.mark.parametrize("cut", (0.3, 0.9))
def test_a_cut_stream_raises(cut):
    data = warc.record(1, "http://a", bytes(range(256)) * 50, None)
    broken = gzip.compress(data[: int(len(data) * cut)])
    with pytest.raises((EOFError, ValueError)):
        warc.normalise_stream(io.BytesIO(broken), io.BytesIO(), io.BytesIO())


def test_not_an_archive_raises():
    with pytest.raises(ValueError):
        warc.normalise_stream(io.BytesIO(gzip.compress(b"hello\r\n\r\n")), io.BytesIO(), io.BytesIO())


def test_empty_table(spark):
    table = pages(spark, [])
    assert warc.round_trip(table, scratch(table, "test-empty")).count() == 0
