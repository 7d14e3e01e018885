"""Every registered query against its SQL twin at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from registry.check import compare
from registry.oracle import ORACLE
from registry.queries import QUERIES
from registry.standins import BASE_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note
