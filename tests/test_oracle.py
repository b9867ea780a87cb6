"""Every registered query equals its SQL on the smallest given tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    text, ok = compare(spark, con, FOLDER, name)
    assert ok, text


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
