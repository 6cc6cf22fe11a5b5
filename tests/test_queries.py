"""All queries against their SQL at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_sql(spark, name):
    said, _ = compare(spark, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert said.startswith("ok"), said


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_entry(spark):
    assert entry.entry(spark).count() == 10
