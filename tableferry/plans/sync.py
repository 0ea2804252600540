"""Full refresh: stage, validate, publish, audit, for one table or a whole source."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tableferry.frames import small_frame
from tableferry.functions.projection import ProjectionOptions, project
from tableferry.functions.types import SourceColumn
from tableferry.operators.audit import (
    AUDIT_TABLE,
    append_audit,
    audit_record,
    ensure_audit_table,
)
from tableferry.operators.stage import load_pieces, load_staging, waits_of
from tableferry.operators.target import STAGING, Target
from tableferry.operators.validate import json_types_ok, validate_count
from tableferry.plans.report import run_report, run_summary
from tableferry.plans.status import (
    CONNECTION_ERROR,
    CRASHED,
    ERROR,
    FAILED,
    SUCCESS,
    VALIDATION_FAILED,
    VALIDATION_MESSAGE,
    WORKER_ERROR,
)
from tableferry.sources.base import Source, table_names

log = logging.getLogger(__name__)

RESULT_SCHEMA = """
    table string,
    status string,
    rows_loaded bigint,
    rows_validated bigint,
    expected_count bigint,
    actual_count bigint,
    error string
"""


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class SyncOptions:
    """Settings of a run.

    ``workers``: tables loaded at the same time. ``load_ts``: the load stamp; now if not given.
    ``keep_backups``: previous versions to keep (0 none, ``None`` all). ``recount_source``: also
    compare the stored count with a fresh count of the source. ``write_attempts``: tries of a
    staging write that fails for reasons outside the data. ``drop_orphans``: let a run first delete
    folders left by a driver that was lost while writing (not while another run uses the schema).
    ``audit_batch``: tables recorded by one append to the audit.
    """

    exclude: Sequence[str] = ()
    workers: int = 1
    load_ts: datetime | None = None
    keep_backups: int | None = 0
    recount_source: bool = False
    write_attempts: int = 3
    drop_orphans: bool = False
    audit_batch: int = 100
    write_options: dict[str, str] = field(default_factory=dict)
    projection: ProjectionOptions = ProjectionOptions()
    clock: Callable[[], datetime] = utc_now

    def __post_init__(self):
        if self.write_attempts < 1:
            raise ValueError(f"write_attempts must be 1 or more, not {self.write_attempts}")


def new_result(table: str, status: str = FAILED, error: str | None = None, counts=True) -> dict:
    known = 0 if counts else None
    return {
        "table": table,
        "status": status,
        "rows_loaded": known,
        "rows_validated": known,
        "expected_count": known,
        "actual_count": known,
        "error": error,
    }


def error_text(error: BaseException) -> str:
    """The message of an error without the JVM stack trace."""
    java = getattr(error, "java_exception", None)
    text = java.getMessage() if java is not None else str(error)
    return text or type(error).__name__


def load_table(
    source: Source,
    target: Target,
    table: str,
    options: SyncOptions = SyncOptions(),
) -> dict:
    """Load one table. Always returns a result; a failure leaves the previous table as it was."""
    result = new_result(table)
    try:
        moment = options.load_ts or options.clock()
        target.check_name(table)  # the catalog itself would only refuse it after the write
        target.restore_if_missing(table)
        columns = source.columns(table)
        with source.snapshot(table):
            result["rows_loaded"] = _stage(source, target, table, columns, moment, options)

            staging = f"{table}{STAGING}"
            check = validate_count(result["rows_loaded"], target, staging)
            result["expected_count"], result["actual_count"] = check.expected, check.actual
            valid = check.ok and json_types_ok(target, staging, columns)
            if valid and options.recount_source:
                result["expected_count"] = source.count(table).first().row_count
                valid = result["expected_count"] == check.actual

        if valid:
            target.swap(table, moment, options.keep_backups)
            result["status"] = SUCCESS
            result["rows_validated"] = result["rows_loaded"]
        else:
            result["status"] = VALIDATION_FAILED
            result["error"] = VALIDATION_MESSAGE
    except Exception as error:
        result["status"] = ERROR
        result["error"] = error_text(error)
        log.error("loading %s failed: %s", table, result["error"])
        log.debug("loading %s failed", table, exc_info=True)
    if result["status"] != SUCCESS:
        try:
            target.drop(f"{table}{STAGING}")
        except Exception as error:  # the result keeps what went wrong first
            log.warning("%s: staging not dropped: %s", table, error_text(error))
    log.info("%s: %s, %s rows", table, result["status"], result["rows_loaded"])
    return result


def _stage(
    source: Source,
    target: Target,
    table: str,
    columns: Sequence[SourceColumn],
    moment: datetime,
    options: SyncOptions,
) -> int:
    """Write a table to staging, in one job or piece by piece; returns the rows written."""

    def opened(wave: Callable[[], DataFrame]) -> DataFrame:
        return project(wave(), columns, moment, options.projection)

    waves = source.waves(table)
    waits = waits_of(options.write_attempts)
    if len(waves) > 1:
        projected = [partial(opened, wave) for wave in waves]
        return load_pieces(projected, target, table, waits, options.write_options)
    written = load_staging(opened(waves[0]), target, table, waits, options.write_options)
    if written is None:
        log.warning("%s: rows written not reported, counting the source", table)
        written = source.count(table).first().row_count
    return written


def attempt_table(
    source: Source,
    target: Target,
    table: str,
    options: SyncOptions = SyncOptions(),
) -> dict:
    """:func:`load_table` behind a connection check, with the failures around it told apart."""
    try:
        source.check()
        target.check()
    except Exception as error:
        return new_result(table, CONNECTION_ERROR, error_text(error), counts=False)
    try:
        return load_table(source, target, table, options)
    except Exception as error:
        return new_result(table, WORKER_ERROR, error_text(error), counts=False)


def sync_table(
    source: Source,
    target: Target,
    table: str,
    options: SyncOptions = SyncOptions(),
) -> dict:
    """Load one table and record it in the audit."""
    start = options.clock()
    source.refresh()
    result = attempt_table(source, target, table, options)
    audit = _Audit(source, target, options)
    audit.add(result, start, options.clock())
    audit.flush()
    return result


def refused_names(tables: Sequence[str]) -> dict[str, str]:
    """Tables that would overwrite each other or the audit, with the reason."""
    shared = Counter(table.lower() for table in tables)
    refused = {t: "table names differ only by case" for t in tables if shared[t.lower()] > 1}
    refused |= {t: "name of the audit table" for t in tables if t.lower() == AUDIT_TABLE}
    return refused


@dataclass
class SyncRun:
    """Outcome of a run: one result per table, and what follows from them."""

    spark: SparkSession
    started: datetime
    ended: datetime
    results: list[dict]
    tables: int
    critical_error: str | None = None

    @property
    def duration(self) -> float:
        return (self.ended - self.started).total_seconds()

    @property
    def results_frame(self) -> DataFrame:
        return small_frame(self.spark, self.results, RESULT_SCHEMA)

    def summary(self, duration: float | None = None) -> DataFrame:
        seconds = self.duration if duration is None else duration
        return run_summary(self.results_frame, self.tables, seconds, self.critical_error)

    def report(
        self, title: str, moment: datetime | None = None, duration: float | None = None
    ) -> DataFrame:
        seconds = self.duration if duration is None else duration
        return run_report(
            self.results_frame,
            self.tables,
            title,
            moment or self.ended,
            seconds,
            self.critical_error,
        )


def sync_all(source: Source, target: Target, options: SyncOptions = SyncOptions()) -> SyncRun:
    """Load every table of a source. A table that fails does not stop the others.

    Each table is one Spark write; the threads here only submit them.
    """
    spark = target.spark
    started = options.clock()
    results: list[dict] = []
    tables: list[str] = []
    critical_error = None
    audit = None
    try:
        source.refresh()
        source.check()
        target.ensure()
        audit = _Audit(source, target, options)
        if options.drop_orphans:
            target.drop_orphans()
        tables = table_names(source, options.exclude)
        refused = refused_names(tables)

        def finish(result: dict, start: datetime, end: datetime) -> None:
            results.append(result)
            audit.add(result, start, end)

        def work(table: str) -> tuple[dict, datetime, datetime]:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
            start = options.clock()
            return attempt_table(source, target, table, options), start, options.clock()

        for table, reason in refused.items():
            finish(new_result(table, ERROR, reason), started, options.clock())
        with ThreadPoolExecutor(max_workers=max(1, options.workers)) as pool:
            # Wrapped once per table: the wrapper carries the local properties of its thread.
            futures = {
                pool.submit(inheritable_thread_target(spark)(work), table): table
                for table in tables
                if table not in refused
            }
            for future in as_completed(futures):
                try:
                    finish(*future.result())
                except Exception as error:
                    crash = new_result(futures[future], CRASHED, error_text(error), counts=False)
                    finish(crash, started, options.clock())
    except Exception as error:
        critical_error = error_text(error)
        log.critical("run failed: %s", critical_error, exc_info=True)
    finally:
        if audit is not None:
            audit.flush()

    results.sort(key=lambda result: result["table"])
    return SyncRun(spark, started, options.clock(), results, len(tables), critical_error)


class _Audit:
    """Collects audit records and appends them in batches, so that a long run leaves its audit
    behind even if the driver is lost. Failing to write it does not fail the loads."""

    def __init__(self, source: Source, target: Target, options: SyncOptions):
        self.source = source
        self.target = target
        self.options = options
        self.records: list[dict] = []
        try:
            ensure_audit_table(target)
        except Exception as error:
            log.warning("no audit table: %s", error)

    def add(self, result: dict, start: datetime, end: datetime) -> None:
        fixed = self.options.load_ts  # a given stamp makes the whole record reproducible
        record = audit_record(result, self.source.schema, fixed or start, fixed or end)
        self.records.append(record)
        if len(self.records) >= self.options.audit_batch:
            self.flush()

    def flush(self) -> None:
        records, self.records = self.records, []
        if not records:
            return
        try:
            append_audit(self.target, records)
        except Exception as error:
            log.warning("audit not written: %s", error)
