"""Every registered query against DuckDB, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_has_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
