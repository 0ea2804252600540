from datetime import datetime, timezone

import pytest

from tableferry import CatalogSource, FrameSource, SyncOptions, Target, reconcile, sync_all
from tableferry.frames import small_frame
from tableferry.operators.counts import COUNT_SCHEMA, collect_counts, count_tables, target_counts
from tableferry.plans.reconcile import (
    compare_counts,
    count_totals,
    mismatch_lines,
    mismatches,
    reconcile_lines,
    source_lines,
    total_line,
)
from tableferry.sources import count_rows

SOURCE = [("t_equal", 10), ("t_short", 10), ("t_long", 10), ("t_missing", 10)]
TARGET = [("T_EQUAL", 10), ("t_short", 7), ("T_LONG", 12), ("t_only_here", 99)]


@pytest.fixture
def details(spark):
    return compare_counts(small_frame(spark, SOURCE, COUNT_SCHEMA), small_frame(spark, TARGET, COUNT_SCHEMA))


def test_details(details):
    rows = {r.table_name: tuple(r)[1:] for r in details.collect()}
    assert rows == {
        "t_equal": (10, 10, False, 0, False),
        "t_short": (10, 7, True, -3, False),
        "t_long": (10, 12, True, 2, False),
        "t_missing": (10, None, True, 0, True),
    }


def test_totals(details):
    row = count_totals(details).first()
    assert (row.tables, row.source_total, row.target_total, row.mismatches) == (4, 40, 29, 3)
    assert {r.table_name for r in mismatches(details).collect()} == {"t_short", "t_long", "t_missing"}


def test_lines(details):
    lines = {r.table_name: r.line for r in reconcile_lines(details).collect()}
    assert lines["t_equal"] == f"✓ {'t_equal':40} | PG: {10:10} | SF: {'10':10}"
    assert lines["t_missing"] == f"✗ {'t_missing':40} | PG: {10:10} | SF: {'NOT FOUND':10}"
    diffs = {r.table_name: r.line for r in mismatch_lines(details).collect()}
    assert diffs["t_short"] == f"  {'t_short':40} | Diff: {-3:+10}"
    assert diffs["t_long"] == f"  {'t_long':40} | Diff: {2:+10}"
    assert total_line(count_totals(details)).first().line == f"TOTALS: PostgreSQL: {40:10} | Snowflake: {29:10}"
    assert {r.line for r in source_lines(details).collect()} >= {f"{'t_long':40} | {10:10}"}


def test_long_names_are_not_cut(spark):
    name = "n" * 55
    details = compare_counts(small_frame(spark, [(name, 1)], COUNT_SCHEMA), small_frame(spark, [], COUNT_SCHEMA))
    assert name in reconcile_lines(details).first().line


def test_end_to_end(spark, target):
    tables = {"a": spark.range(3), "b": spark.range(0), "c": spark.range(2)}
    source = FrameSource(spark, tables)
    options = SyncOptions(exclude=["c"], load_ts=datetime(2024, 1, 1, tzinfo=timezone.utc))
    sync_all(source, target, options)
    details, totals = reconcile(source, target)
    rows = {r.table_name: (r.source_count, r.target_count, r.is_mismatch) for r in details.collect()}
    assert rows == {"a": (3, 3, False), "b": (0, 0, False), "c": (2, None, True)}
    assert tuple(totals.first()) == (3, 5, 3, 1)
    details, totals = reconcile(source, target, exclude=["c"])
    assert totals.first().mismatches == 0


def test_target_may_be_any_source(spark):
    left = FrameSource(spark, {"a": spark.range(3), "b": spark.range(1)})
    right = FrameSource(spark, {"A": spark.range(2), "z": spark.range(9)})
    details, totals = reconcile(left, right)
    assert sorted((r.table_name, r.target_count, r.diff) for r in details.collect()) == [("a", 2, -1), ("b", None, 0)]
    assert totals.first().target_total == 2


def test_unreachable_target_leaves_the_source_side(spark):
    details, totals = reconcile(FrameSource(spark, {"a": spark.range(3)}), Target(spark, "no_such_schema"))
    assert (details.first().source_count, details.first().target_count) == (3, None)
    assert totals.first().source_total == 3 and totals.first().target_total == 0


def test_source_that_cannot_be_counted_is_an_error(spark, target):
    broken = spark.range(1).selectExpr("id").filter("raise_error('gone') IS NULL")
    with pytest.raises(Exception, match="gone"):
        reconcile(FrameSource(spark, {"a": broken}), target)


def test_target_that_cannot_be_counted_has_no_count(spark, target):
    spark.range(4).write.saveAsTable(target.name("good"))
    spark.sql(f"CREATE VIEW {target.name('bad')} AS SELECT id FROM range(3) WHERE raise_error('gone') IS NULL")
    counts = target_counts(CatalogSource(spark, target.schema), ["GOOD", "bad", "absent"])
    assert [tuple(r) for r in counts.collect()] == [("good", 4)]


def test_source_names_that_differ_by_case_share_a_target(spark, target):
    spark.range(4).write.saveAsTable(target.name("orders"))
    source = FrameSource(spark, {"Orders": spark.range(4), "orders": spark.range(3)})
    details, _ = reconcile(source, target)
    assert sorted((r.table_name, r.target_count, r.diff) for r in details.collect()) == [("Orders", 4, 0), ("orders", 4, 1)]


def test_counts_of_many_tables(spark):
    frames = {f"t{i}": count_rows(spark.range(i)) for i in range(5)}
    assert {r.table_name: r.row_count for r in count_tables(spark, frames).collect()} == {f"t{i}": i for i in range(5)}
    assert count_tables(spark, {}).count() == 0
    assert collect_counts(spark, frames, per_query=2) == {f"t{i}": i for i in range(5)}
