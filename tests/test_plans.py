"""Plans that must hold at any size: no shuffle in a load, only the needed columns read."""

import os
from datetime import datetime, timezone

import pytest

from tableferry import ParquetSource, project, with_row_hash
from tableferry.operators.counts import count_tables
from tableferry.operators.messages import select_purgeable

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
STAMP = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def source(spark):
    return ParquetSource(spark, DATA, types={"events": {"props": "jsonb"}})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("table", ["lineitem", "events", "embeddings", "documents"])
def test_a_load_is_map_only(source, table):
    text = plan(project(source.read(table), source.columns(table), STAMP))
    assert "Exchange" not in text and "Python" not in text
    assert "FileScan parquet" in text


def test_row_hash_is_map_only(source):
    text = plan(with_row_hash(source.read("events"), source.columns("events")))
    assert "Exchange" not in text and "Python" not in text


def test_counts_read_no_column(spark, source):
    text = plan(count_tables(spark, {t: source.count(t) for t in ("orders", "lineitem")}))
    assert text.count("ReadSchema: struct<>") == 2
    assert text.count("partial_count") == 2


def test_pruned_columns_and_pushed_filters(source):
    rows = project(source.read("lineitem"), source.columns("lineitem"), STAMP)
    text = plan(rows.filter("L_QUANTITY > 49").select("L_ORDERKEY"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49.0)]" in text


def test_purge_reads_the_text_only(source):
    text = plan(select_purgeable(source.read("conversations"), ["The "]).select("conv_id"))
    assert "ReadSchema: struct<conv_id:bigint,text:string>" in text
