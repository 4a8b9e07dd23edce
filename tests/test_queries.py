"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name)) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_id", "user_id", "event_type", "value"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
