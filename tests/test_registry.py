"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, con, name):
    if name not in entry.oracle_sql():
        pytest.skip("beyond SQL: tested against brute force")
    assert difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["full_name", "author_count", "author_weight"]
