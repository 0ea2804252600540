"""Incremental loads: late rows, runs that are cut off, failures, plans."""

from collections import Counter
from datetime import datetime

import pytest

from tableferry import FrameSource
from tableferry.operators.audit import AUDIT_TABLE
from tableferry.plans import increment
from tableferry.plans.increment import LOAD_ID, Cursor, high_water, rows_from, sync_increment

SCHEMA = "id bigint, ts timestamp_ntz, body string"


def source(spark, rows, schema=SCHEMA, types=None):
    return FrameSource(spark, {"log": spark.createDataFrame(rows, schema)}, types=types)


def at(second):
    if second < 0:
        return datetime(1969, 12, 31, 23, 59, 50, 250_000)
    return datetime(2024, 3, 31, 2, 30, second, 123_456)


def rows(n, start=0):
    return [(i, at(i), f"row {i}") for i in range(start, n)]


def stored(target):
    return sorted(r.ID for r in target.read("log").collect())


def mark_of(moment):
    return round((moment - datetime(1970, 1, 1)).total_seconds() * 1e6)


def test_increments_add_up_to_a_full_load(spark, target):
    cursor = Cursor("ts", ["id"])
    counts = [sync_increment(source(spark, rows(n)), target, "log", cursor)["rows_loaded"] for n in (10, 10, 25)]
    assert counts == [10, 0, 15] and stored(target) == list(range(25))
    assert high_water(target, "log") == mark_of(at(24))
    assert target.read("log").select(LOAD_ID).distinct().count() == 2


def test_late_rows_within_the_overlap_are_found(spark, target):
    cursor = Cursor("ts", ["id"], overlap=5_000_000)
    sync_increment(source(spark, rows(20)), target, "log", cursor)
    late = rows(20) + [(101, at(16), "late"), (102, at(3), "too late"), (20, at(20), "new")]
    sync_increment(source(spark, late), target, "log", cursor)
    assert stored(target) == [*range(21), 101]


def test_null_keys_and_cursors(spark, target):
    cursor = Cursor("ts", ["id"], overlap=10_000_000)
    first = rows(5) + [(None, at(4), "no id"), (7, None, "no time")]
    for _ in range(2):
        sync_increment(source(spark, first), target, "log", cursor)
    assert Counter(r.BODY for r in target.read("log").collect()) == Counter(r[2] for r in first)


def test_a_run_cut_off_before_the_audit_adds_nothing_twice(spark, target, monkeypatch):
    cursor = Cursor("ts", ["id"])
    sync_increment(source(spark, rows(5)), target, "log", cursor)
    with monkeypatch.context() as patch:
        patch.setattr(increment, "append_audit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            sync_increment(source(spark, rows(12)), target, "log", cursor)
    assert stored(target) == list(range(12)) and high_water(target, "log") == mark_of(at(4))
    result = sync_increment(source(spark, rows(12)), target, "log", cursor)
    assert result["rows_loaded"] == 0 and stored(target) == list(range(12))


def test_a_failure_leaves_table_and_mark(spark, target):
    cursor = Cursor("id", ["id"])
    schema, types = "id bigint, ts timestamp_ntz, body string", {"log": {"body": "jsonb"}}
    good = [(i, at(i), '{"a": 1}') for i in range(3)]
    sync_increment(source(spark, good, schema, types), target, "log", cursor)
    result = sync_increment(source(spark, [*good, (9, at(9), "{")], schema, types), target, "log", cursor)
    assert result["status"] == "ERROR" and stored(target) == [0, 1, 2] and high_water(target, "log") == 2
    audit = target.read(AUDIT_TABLE).orderBy("LOAD_START").collect()
    assert [(r.STATUS, r.LAST_SOURCE_ID) for r in audit] == [("SUCCESS", 2), ("ERROR", 2)]


def test_before_1970_and_other_zones(spark, target):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 is skipped on that day
        sync_increment(source(spark, [(1, at(-1), "x"), (2, at(0), "y")]), target, "log", Cursor("ts", ["id"]))
        assert high_water(target, "log") == mark_of(at(0))
        sync_increment(source(spark, [(1, at(-1), "x")]), target, "log", Cursor("ts", ["id"]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert stored(target) == [1, 2]


def test_the_range_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(rows(5), SCHEMA).write.parquet(str(tmp_path / "log.parquet"))
    read = rows_from(spark.read.parquet(str(tmp_path / "log.parquet")), "ts", mark_of(at(2)))
    assert read.count() == 3
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-03-31T02:30:02.123456)" in plan


def test_a_cursor_that_does_not_grow_in_numbers_is_refused(spark, target):
    result = sync_increment(source(spark, rows(2)), target, "log", Cursor("body", ["id"]))
    assert result["status"] == "ERROR" and "not a cursor" in result["error"] and not target.exists("log")
