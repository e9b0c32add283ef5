from __future__ import annotations

import pytest

from orderlens.llm import url_filter
from support import same, sql_rows

URLS = [
    None,
    "",
    "no scheme/de/",
    "http://",
    "http://org",
    "http://org/",
    "HTTP://A.ORG/x",
    "http://xorg/",
    "http://example.org/es/1",
    "http://www.EXAMPLE.org/en/12?q=/es/",
    "http://example.org/en/2",
    "http://a.com/de/x#y",
    "http://a.com/fr/x?casino",
    "http://com/de/",
    "http://a.net/casino/",
    "http://a.net/casinos/",
    "http://a.net/x?poker&bet",
    "http://a.net/x?poker&poker",
    "http://a.net/poker-beta",
    "http://poker.bet",
    "http://Ä.net/XXX",
    "a://b://c/porn",
    "http://a.net/" + "z" * 100_000 + "/porn",
]


def pages(spark, urls):
    rows = [(i, u, "h", "v", 1) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, verdict string, rule int")


def test_against_sql(spark):
    table = pages(spark, [*URLS, "http://poker.bet"])
    judged = url_filter.filter_urls(table, ["page_id", "host", "rule"])
    same(judged, *sql_rows(url_filter.oracle_sql(), pages=table))


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("http://A.b?x", "a.b", ""),
        ("http://a.b#/x", "a.b", ""),
        ("http://a.b/c/?d", "a.b", "/c/"),
        ("x", "", ""),
        ("http://İ.com/", "İ.com", "/"),
    ],
)
def test_parts(url, host, path):
    assert url_filter.split_url(url) == (host, path)


def test_longest_rule_wins_over_hosts():
    rules = url_filter.host_rules((("allow", "b.org/"), ("block", "a.b.org/"), ("allow", "a.b.org/x")))
    assert url_filter.fitting("a.b.org", "/x/y", rules) == ("a.b.org/x", "allow")
    assert url_filter.fitting("c.a.b.org", "/y", rules) == ("a.b.org/", "block")
    assert url_filter.fitting("b.org", "", rules) is None


def test_empty_table(spark):
    assert url_filter.filter_urls(pages(spark, []), ["page_id"]).count() == 0
