"""Every registered query against its SQL counterpart, on whole tables."""

from pathlib import Path

import pytest
from compare import difference, duck

import __spark_entry__ as entry_module
from starmill.queries import QUERIES

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return duck(ROOT)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = entry_module.queries()[name](spark, ROOT)
    sql = entry_module.oracle_sql().get(name)
    assert sql is not None, "every query so far has an SQL counterpart"
    assert difference(df, con, sql) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
