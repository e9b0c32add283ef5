"""Every registered query against its SQL on the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(entry.core_queries()) == set(entry.core_oracle_sql())


@pytest.mark.parametrize("name", list(entry.core_queries()))
def test_query_equals_sql(spark, sf, con, name):
    assert compare(spark, con, sf, name) == ""


def test_flagship(spark):
    assert entry.entry(spark).count() == 5
