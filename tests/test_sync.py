import os
import threading
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tableferry import CatalogSource, FrameSource, ParquetSource, ProjectionOptions, SyncOptions, Target, sync_all, sync_table
from tableferry.operators import stage
from tableferry.operators.audit import AUDIT_COLUMNS, AUDIT_TABLE, duplicate_audit_keys
from tableferry.operators.stage import is_lasting
from tableferry.operators.target import STAGING, SwapError
from tableferry.plans import sync as sync_module
from tableferry.plans.sync import attempt_table

T1 = datetime(2024, 1, 1, tzinfo=timezone.utc)
T2 = datetime(2024, 1, 2, tzinfo=timezone.utc)


def frames(spark, **tables):
    return {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in tables.items()}


def people(spark, rows):
    return FrameSource(spark, frames(spark, people=(rows, "id int, name string")))


def stored(target, table):
    return sorted(tuple(r) for r in target.read(table).drop("LOADED_AT_UTC").collect())


def load(source, target, table="people", ts=T1, **options):
    return attempt_table(source, target, table, SyncOptions(load_ts=ts, write_attempts=1, **options))


def table_names(spark, target):
    return sorted(t.name for t in spark.catalog.listTables(target.schema))


def version_folders(target, table="people"):
    folder = target.folder.removeprefix("file:") + "/__versions/" + table
    return os.listdir(folder) if os.path.isdir(folder) else []


def test_load_publishes_and_leaves_nothing_behind(spark, target):
    result = load(people(spark, [(1, "a"), (2, None)]), target)
    assert result == {
        "table": "people", "status": "SUCCESS", "rows_loaded": 2, "rows_validated": 2,
        "expected_count": 2, "actual_count": 2, "error": None,
    }
    assert stored(target, "people") == [(1, "a"), (2, None)]
    assert target.read("people").columns == ["ID", "NAME", "LOADED_AT_UTC"]
    assert table_names(spark, target) == ["people"]
    assert len(version_folders(target)) == 1


def test_second_load_replaces_rows_and_schema(spark, target):
    load(people(spark, [(1, "a")]), target)
    wider = FrameSource(spark, frames(spark, people=([(7, 1.5, True)], "id int, x double, y boolean")))
    assert load(wider, target, ts=T2)["status"] == "SUCCESS"
    assert stored(target, "people") == [(7, 1.5, True)]
    assert len(version_folders(target)) == 1  # the old files went with the backup


def test_publishing_moves_no_file(spark, target):
    load(people(spark, [(1, "a")]), target)
    folder = target.describe("people")["location"]
    assert "/__versions/people/" in folder
    load(people(spark, [(2, "b")]), target, ts=T2, keep_backups=1)
    assert target.describe(target.backups("people")[0])["location"] == folder


def test_empty_table_is_loaded_and_published(spark, target):
    load(people(spark, [(1, "a")]), target)
    result = load(people(spark, []), target, ts=T2)
    assert (result["status"], result["rows_loaded"], result["actual_count"]) == ("SUCCESS", 0, 0)
    assert stored(target, "people") == []


def test_count_mismatch_keeps_final(spark, target, monkeypatch):
    load(people(spark, [(1, "a")]), target)
    real = sync_module.load_staging
    monkeypatch.setattr(sync_module, "load_staging", lambda *a: real(*a) + 1)
    result = load(people(spark, [(2, "b"), (3, "c")]), target, ts=T2)
    assert result["status"] == "VALIDATION_FAILED"
    assert result["error"] == "Count or type validation failed"
    assert (result["rows_loaded"], result["rows_validated"]) == (3, 0)
    assert (result["expected_count"], result["actual_count"]) == (3, 2)
    assert stored(target, "people") == [(1, "a")]
    assert table_names(spark, target) == ["people"] and len(version_folders(target)) == 1


def test_type_mismatch_keeps_final(spark, target):
    source = FrameSource(spark, frames(spark, docs=([("{}",)], "j string")), types={"docs": {"j": "json"}})
    assert load(source, target, "docs")["status"] == "SUCCESS"
    result = load(source, target, "docs", T2, projection=ProjectionOptions(json_as="text"))
    assert (result["status"], result["rows_loaded"], result["rows_validated"]) == ("VALIDATION_FAILED", 1, 0)
    assert target.read("docs").select(F.unix_seconds("LOADED_AT_UTC")).first()[0] == int(T1.timestamp())


def test_malformed_json_is_an_error(spark, target):
    good = FrameSource(spark, frames(spark, docs=([("[]",)], "j string")), types={"docs": {"j": "json"}})
    bad = FrameSource(spark, frames(spark, docs=([("{bad",)], "j string")), types={"docs": {"j": "json"}})
    load(good, target, "docs")
    result = load(bad, target, "docs", T2)
    assert result["status"] == "ERROR" and "MALFORMED_RECORD" in result["error"]
    assert "at org.apache" not in result["error"]
    assert table_names(spark, target) == ["docs"] and len(version_folders(target, "docs")) == 1
    lenient = load(bad, target, "docs", T2, projection=ProjectionOptions(on_bad_json="null"))
    assert lenient["status"] == "SUCCESS" and target.read("docs").first().J is None


def test_name_the_catalog_cannot_hold_is_an_error(spark, target):
    for name in ("it's", "a-b", "a b"):
        source = FrameSource(spark, {name: spark.range(1)})
        result = load(source, target, name)
        assert result["status"] == "ERROR" and "not a table name" in result["error"]
        assert version_folders(target, name) == []
    assert table_names(spark, target) == []


def test_staging_of_one_table_is_never_another_table(spark, target):
    source = FrameSource(spark, {n: spark.range(1) for n in ("a", "a__STAGING", "a__backup_20240101_000000")})
    run = sync_all(source, target, SyncOptions())
    assert [r["status"] for r in run.results] == ["SUCCESS", "ERROR", "ERROR"]
    assert table_names(spark, target) == ["a", AUDIT_TABLE]


def test_case_clash_and_stamp_column_are_errors(spark, target):
    clash = FrameSource(spark, {"t": spark.range(1).selectExpr("1 AS a", "2 AS A")})
    assert "differ only by case" in load(clash, target, "t")["error"]
    stamp = FrameSource(spark, {"t": spark.range(1).selectExpr("1 AS loaded_at_utc")})
    assert "LOADED_AT_UTC" in load(stamp, target, "t")["error"]
    assert table_names(spark, target) == []


def test_recount_of_the_source(spark, target):
    assert load(people(spark, [(1, "a")]), target, recount_source=True)["status"] == "SUCCESS"

    class Growing(FrameSource):
        reads = 0

        def read(self, table):
            self.reads += 1
            return super().read(table).unionAll(super().read(table)) if self.reads > 2 else super().read(table)

    growing = Growing(spark, frames(spark, people=([(1, "a")], "id int, name string")))
    result = load(growing, target, ts=T2, recount_source=True)
    assert (result["status"], result["expected_count"], result["actual_count"]) == ("VALIDATION_FAILED", 2, 1)


def test_failed_publish_restores_final(spark, target, monkeypatch):
    load(people(spark, [(1, "a")]), target)
    real = Target.rename

    def rename(self, table, new_name):
        if table.endswith(STAGING):
            raise RuntimeError("no rename")
        real(self, table, new_name)

    monkeypatch.setattr(Target, "rename", rename)
    other = FrameSource(spark, frames(spark, people=([(2, True)], "id int, name boolean")))
    result = load(other, target, ts=T2)
    assert result["status"] == "ERROR" and "no rename" in result["error"]
    assert stored(target, "people") == [(1, "a")] and table_names(spark, target) == ["people"]
    assert not target._is_marked("people")
    with pytest.raises(SwapError):
        target.swap("people", T2)


def test_run_cut_off_between_the_renames_is_repaired(spark, target):
    load(people(spark, [(1, "a")]), target)
    target._mark("people")
    target.rename("people", "people__backup_20240101_000000")
    bad = FrameSource(spark, {"people": spark.range(1).selectExpr("raise_error('down') AS id")})
    assert load(bad, target, ts=T2)["status"] == "ERROR"
    assert stored(target, "people") == [(1, "a")]
    assert not target.restore_if_missing("people")


def test_backups_are_kept_up_to_a_number(spark, target):
    for i in range(4):
        load(people(spark, [(i, "x")]), target, ts=T1 + timedelta(days=i), keep_backups=2)
    assert target.backups("people") == ["people__backup_20240103_000000", "people__backup_20240104_000000"]
    assert [stored(target, b) for b in target.backups("people")] == [[(1, "x")], [(2, "x")]]
    assert len(version_folders(target)) == 3


def test_all_backups_even_within_one_second(spark, target):
    for i in range(3):
        load(people(spark, [(i, "x")]), target, keep_backups=None)
    assert len(target.backups("people")) == 2 and stored(target, "people") == [(2, "x")]


def test_lost_count_of_the_write_is_replaced_by_the_source(spark, target, monkeypatch):
    blocked = threading.Event()
    monkeypatch.setattr(stage, "OBSERVE_SECONDS", 0.2)
    monkeypatch.setattr(stage.Observation, "get", property(lambda self: {"rows": blocked.wait(30)}))
    result = load(people(spark, [(1, "a"), (2, "b")]), target)
    blocked.set()
    assert (result["status"], result["rows_loaded"]) == ("SUCCESS", 2)


def test_folders_of_a_lost_driver_can_be_dropped(spark, target):
    load(people(spark, [(1, "a")]), target)
    load(people(spark, [(2, "b")]), target, ts=T2, keep_backups=1)
    spark.range(3).write.parquet(target.new_folder("people"))
    assert len(version_folders(target)) == 3
    target.rename(target.backups("people")[0], "archive")
    sync_all(people(spark, [(3, "c")]), target, SyncOptions(load_ts=T2 + timedelta(days=1), drop_orphans=True))
    assert len(version_folders(target)) == 2
    assert stored(target, "people") == [(3, "c")] and stored(target, "archive") == [(1, "a")]
    assert target.drop_orphans() == []


def test_backup_that_cannot_be_dropped_does_not_fail_the_load(spark, target, monkeypatch):
    load(people(spark, [(1, "a")]), target)
    real = Target.drop

    def drop(self, table):
        if "__backup_" in table:
            raise OSError("busy")
        real(self, table)

    monkeypatch.setattr(Target, "drop", drop)
    assert load(people(spark, [(2, "b")]), target, ts=T2)["status"] == "SUCCESS"
    assert stored(target, "people") == [(2, "b")] and len(target.backups("people")) == 1


def test_single_load_is_audited(spark, target):
    assert sync_table(people(spark, [(1, "a")]), target, "people", SyncOptions(load_ts=T1))["status"] == "SUCCESS"
    sync_table(people(spark, []), target, "no_such_table", SyncOptions(load_ts=T1))
    rows = target.read(AUDIT_TABLE).orderBy("TABLE_NAME").collect()
    assert [(r.TABLE_NAME, r.STATUS, r.ROWS_LOADED) for r in rows] == [("no_such_table", "ERROR", 0), ("people", "SUCCESS", 1)]


def test_connection_and_worker_errors(spark, target, monkeypatch):
    class Down(FrameSource):
        def check(self):
            raise ConnectionError("refused")

    result = load(Down(spark, {}), target)
    assert (result["status"], result["error"], result["rows_loaded"]) == ("CONNECTION_ERROR", "refused", None)
    absent = load(people(spark, []), Target(spark, "no_such_schema"))
    assert absent["status"] == "CONNECTION_ERROR" and "no_such_schema" in absent["error"]

    def boom(*args):
        raise RuntimeError("boom")

    monkeypatch.setattr(sync_module, "load_table", boom)
    result = load(people(spark, []), target)
    assert (result["status"], result["error"]) == ("WORKER_ERROR", "boom")


def run_source(spark):
    tables = frames(
        spark,
        a=([(1,), (2,)], "id int"),
        b=([("{bad",)], "j string"),
        c=([], "id int"),
        excluded_log=([(1,)], "id int"),
    )
    return FrameSource(spark, tables, types={"b": {"j": "json"}})


@pytest.mark.parametrize("workers", [1, 4])
def test_sync_all_isolates_failures(spark, target, workers):
    options = SyncOptions(exclude=["excluded_log"], workers=workers, load_ts=T1)
    run = sync_all(run_source(spark), target, options)
    assert [(r["table"], r["status"]) for r in run.results] == [("a", "SUCCESS"), ("b", "ERROR"), ("c", "SUCCESS")]
    assert table_names(spark, target) == ["a", "c", AUDIT_TABLE]
    summary = run.summary().first()
    assert (summary.status, summary.tables_processed, summary.successes, summary.failures, summary.total_rows) == (
        "FAILURE", 3, 2, 1, 2,
    )
    assert [f.table for f in summary.failed_tables] == ["b"]


def test_audit_has_one_row_per_attempted_table(spark, target):
    for ts in (T1, T2):
        sync_all(run_source(spark), target, SyncOptions(load_ts=ts))
    audit = target.read(AUDIT_TABLE)
    assert audit.columns == [line.split()[0] for line in AUDIT_COLUMNS.strip().splitlines()]
    assert audit.count() == 8
    assert duplicate_audit_keys(audit).isEmpty()
    row = audit.filter("TABLE_NAME = 'b'").first()
    assert (row.STATUS, row.LOAD_TYPE, row.SOURCE_SCHEMA, row.ROWS_LOADED) == ("ERROR", "FULL_LOAD", "public", 0)
    assert "MALFORMED" in row.ERROR_MESSAGE and row.LAST_SOURCE_ID is None and row.ROW_HASH is None
    assert row.LOAD_END == row.LOADED_AT_UTC
    assert audit.filter("TABLE_NAME = 'excluded_log'").count() == 2
    sync_all(run_source(spark), target, SyncOptions(load_ts=T2))
    assert duplicate_audit_keys(target.read(AUDIT_TABLE)).count() == 4


def test_audit_times_are_those_of_each_table(spark, target):
    ticks = iter(T1 + timedelta(minutes=i) for i in range(1000))
    options = SyncOptions(clock=lambda: next(ticks), exclude=["b", "excluded_log"])
    run = sync_all(run_source(spark), target, options)
    a, c = target.read(AUDIT_TABLE).orderBy("TABLE_NAME").collect()
    seconds = [t.timestamp() for t in (run.started, a.LOAD_START, a.LOAD_END, c.LOAD_START, c.LOAD_END, run.ended)]
    assert seconds == sorted(seconds) and len(set(seconds)) == 6


def test_audit_is_written_while_the_run_goes_on(spark, target, monkeypatch):
    sizes, real = [], sync_module.append_audit
    monkeypatch.setattr(sync_module, "append_audit", lambda t, rows: sizes.append(len(rows)) or real(t, rows))
    source = FrameSource(spark, {f"t{i}": spark.range(i) for i in range(5)})
    sync_all(source, target, SyncOptions(workers=2, audit_batch=2))
    assert sizes == [2, 2, 1] and target.read(AUDIT_TABLE).count() == 5


def test_audit_failure_does_not_fail_the_run(spark, target, monkeypatch):
    def broken(*args):
        raise RuntimeError("audit is down")

    monkeypatch.setattr(sync_module, "append_audit", broken)
    monkeypatch.setattr(sync_module, "ensure_audit_table", broken)
    run = sync_all(people(spark, [(1, "a")]), target, SyncOptions())
    assert run.summary().first().status == "SUCCESS"


def test_no_tables_is_a_failure(spark, target):
    run = sync_all(FrameSource(spark, {}), target, SyncOptions())
    summary = run.summary().first()
    assert (summary.status, summary.tables_processed, summary.total_rows) == ("FAILURE", 0, 0)


def test_critical_failure(spark, target):
    run = sync_all(ParquetSource(spark, "/nowhere/at/all"), target, SyncOptions())
    summary = run.summary().first()
    assert summary.status == "CRITICAL_FAILURE" and summary.failures == 0
    assert summary.failed_tables[0].table == "Pipeline Level"
    assert "/nowhere/at/all" in summary.failed_tables[0].error
    assert run.report("Copy").first().report.startswith("Copy: Sync Failed | ")


def test_crash_of_a_worker(spark, target, monkeypatch):
    real = sync_module.attempt_table

    def crash(source, target_, table, options):
        if table == "a":
            raise RuntimeError("thread died")
        return real(source, target_, table, options)

    monkeypatch.setattr(sync_module, "attempt_table", crash)
    run = sync_all(run_source(spark), target, SyncOptions(exclude=["b", "excluded_log"]))
    assert [(r["table"], r["status"], r["error"]) for r in run.results] == [
        ("a", "CRASHED", "thread died"),
        ("c", "SUCCESS", None),
    ]


def test_tables_that_would_overwrite_each_other_are_refused(spark, target):
    one = spark.range(1)
    source = FrameSource(spark, {"Orders": one, "orders": one, "etl_metadata": one, "fine": one})
    run = sync_all(source, target, SyncOptions(load_ts=T1))
    assert {r["table"]: (r["status"], r["error"]) for r in run.results} == {
        "Orders": ("ERROR", "table names differ only by case"),
        "orders": ("ERROR", "table names differ only by case"),
        "etl_metadata": ("ERROR", "name of the audit table"),
        "fine": ("SUCCESS", None),
    }
    assert target.read(AUDIT_TABLE).count() == 4 and target.read("FINE").count() == 1


def test_tables_run_in_their_own_scheduler_pool(spark, target, monkeypatch):
    seen = {}
    real = sync_module.attempt_table

    def spy(source, target_, table, options):
        result = real(source, target_, table, options)
        seen[table] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return result

    monkeypatch.setattr(sync_module, "attempt_table", spy)
    source = FrameSource(spark, {f"t{i}": spark.range(i) for i in range(6)})
    sync_all(source, target, SyncOptions(workers=3))
    assert seen == {f"t{i}": f"t{i}" for i in range(6)}


def test_repeated_json_key_keeps_its_last_value(spark, target):
    docs = frames(spark, docs=([('{"a":1,"a":2}',)], "j string"))
    assert load(FrameSource(spark, docs, types={"docs": {"j": "json"}}), target, "docs")["status"] == "SUCCESS"
    assert target.read("docs").select(F.to_json("J")).first()[0] == '{"a":2}'


def test_catalog_as_source(spark, target, tmp_path):
    load(people(spark, [(1, "a")]), target)
    spark.sql(f"CREATE VIEW {target.schema}.grown_ups AS SELECT * FROM {target.schema}.people")
    source = CatalogSource(spark, target.schema)
    listed = {r.table_name: r.table_type for r in source.listing().collect()}
    assert listed == {"people": "BASE TABLE", "grown_ups": "VIEW"}
    second = Target(spark, target.schema + "_copy", str(tmp_path)).ensure()
    try:
        # The stamp of the first copy is a column of its own here.
        run = sync_all(source, second, SyncOptions())
        assert {r["status"] for r in run.results} == {"ERROR"}
    finally:
        second.drop_schema()


def test_tables_added_later_are_seen(spark, target, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "src" / "one.parquet"))
    source = ParquetSource(spark, str(tmp_path / "src"))
    assert [r["rows_loaded"] for r in sync_all(source, target).results] == [3]
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "src" / "one.parquet"))
    spark.range(2).write.parquet(str(tmp_path / "src" / "two.parquet"))
    assert [r["rows_loaded"] for r in sync_all(source, target).results] == [5, 2]


def failing_write(monkeypatch, errors):
    """Staging writes that raise the given errors in turn, then report 7 rows; returns the waits."""
    waits, left = [], iter(errors)

    def write(*args):
        error = next(left, None)
        if error is not None:
            raise error
        return 7

    monkeypatch.setattr(stage, "write_staging", write)
    monkeypatch.setattr(stage.time, "sleep", waits.append)
    return waits


def test_write_is_tried_again_after_longer_waits(monkeypatch):
    waits = failing_write(monkeypatch, [OSError("1"), OSError("2")])
    assert stage.load_staging(None, None, "t") == 7
    assert waits == [1.0, 2.0]


def test_the_last_error_is_raised(monkeypatch):
    waits = failing_write(monkeypatch, [OSError("1"), OSError("2"), OSError("3")])
    with pytest.raises(OSError, match="3") as raised:
        stage.load_staging(None, None, "t")
    assert waits == [1.0, 2.0] and "OSError: 2" in raised.value.__notes__[0]


def test_errors_in_the_data_are_not_retried(monkeypatch):
    waits = failing_write(monkeypatch, [RuntimeError("[MALFORMED_RECORD_IN_PARSING] SQLSTATE: 22023")])
    with pytest.raises(RuntimeError):
        stage.load_staging(None, None, "t")
    assert waits == [] and not is_lasting(OSError("lost connection"))


def test_second_attempt_does_not_duplicate_rows(spark, target, monkeypatch):
    real, calls = stage.write_staging, []

    def lost_acknowledgement(*args):
        calls.append(1)
        written = real(*args)
        if len(calls) == 1:
            raise OSError("lost acknowledgement")
        return written

    monkeypatch.setattr(stage, "write_staging", lost_acknowledgement)
    monkeypatch.setattr(stage.time, "sleep", lambda s: None)
    options = SyncOptions(load_ts=T1)
    result = sync_table(people(spark, [(1, "a"), (2, "b")]), target, "people", options)
    assert (result["status"], result["rows_loaded"], len(calls)) == ("SUCCESS", 2, 2)
    assert stored(target, "people") == [(1, "a"), (2, "b")] and len(version_folders(target)) == 1
