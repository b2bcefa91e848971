"""Every registered query beside its SQL, on the smallest tables; and the contract of the entry module."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
