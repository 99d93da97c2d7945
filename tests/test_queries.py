"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry

from .oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["Status"] for r in rows} == {"open", "closed", "pending"}
