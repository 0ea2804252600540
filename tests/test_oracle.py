"""Every registered query against its SQL, and the entry points."""

import os

import pytest

from tableferry.registry.oracle import ORACLE
from tableferry.registry.queries import QUERIES
from tests.oracle_check import compare, connect

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, name, DATA) is None


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark)
    assert rows.count() == 1000 and "PROPS" in rows.columns


def test_queries_can_run_again(spark, connection):
    for name in ("swap_publishes_new_rows", "load_orders", "backup_keeps_old_rows"):
        assert compare(spark, connection, name, DATA) is None
