"""Queries with every session treated as too large for one task: same rows as the SQL."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", ["coloring_segmentation", "tracing_segmentation", "json_unknown_fields", "strict_touch_pattern",
                                  "temporal_features", "statistical_outliers", "flagged_row_ranges", "isolation_forest"])
def test_large_sessions(spark, name):
    spark.conf.set("fingertrail.hotRows", "450")
    try:
        message = compare(spark, connect(SF_DIR), SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name))
    finally:
        spark.conf.unset("fingertrail.hotRows")
    assert message is None
