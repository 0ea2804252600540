"""Incremental load: only rows beyond a high-water mark, published by one catalog operation.

The table is partitioned by load. An increment is written into a folder of its own, counted, and then
becomes a partition: readers see all of it or none. The mark is kept in the audit. It may be behind what is
published, if a run was cut off between the two, but never ahead: rows of an overlap below the mark are
read again, and those whose key the table already holds are left out.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.projection import project, quote_identifier
from tableferry.operators.audit import AUDIT_TABLE, append_audit, audit_record, ensure_audit_table
from tableferry.operators.stage import WRITE_OPTIONS
from tableferry.operators.target import Target
from tableferry.plans.status import ERROR, SUCCESS, VALIDATION_FAILED, VALIDATION_MESSAGE
from tableferry.plans.sync import SyncOptions, error_text, new_result
from tableferry.sources.base import Source
from tableferry.storage import delete_folder

log = logging.getLogger(__name__)

INCREMENTAL = "INCREMENTAL"
LOAD_ID = "load_id"
FOLDERS = "__increments"
_EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Cursor:
    """What grows: a whole number, or a time stamp without zone.

    ``key``: columns that name a row. ``overlap``: how far below the mark rows are read again, for those that
    come in late; in units of the number, or in microseconds. Rows without a cursor are loaded by
    the first run only.
    """

    column: str
    key: Sequence[str]
    overlap: int = 0


def position(value: Column, data_type: T.DataType) -> Column:
    """A cursor as a whole number."""
    if isinstance(data_type, T.TimestampNTZType):
        # From its fields, so that no time zone takes part.
        days = F.unix_date(value.cast("date")).cast("bigint")
        minutes = (days * 24 + F.hour(value)) * 60 + F.minute(value)
        seconds = F.extract(F.lit("SECOND"), value)  # with six digits behind the point
        return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")
    if isinstance(data_type, T.IntegralType):
        return value.cast("bigint")
    raise ValueError(f"not a cursor: {data_type.simpleString()}")


def cursor_literal(place: int, data_type: T.DataType) -> Column:
    """The cursor at a whole number, in the column's own type, so that a filter reaches the scan."""
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(str(_EPOCH + timedelta(microseconds=place))).cast("timestamp_ntz")
    return F.lit(place).cast(data_type)


def high_water(target: Target, table: str) -> int | None:
    """The mark up to which a table is loaded; ``None`` before its first increment."""
    audit = target.read(AUDIT_TABLE).where(
        (F.col("TABLE_NAME") == table) & (F.col("LOAD_TYPE") == INCREMENTAL) & (F.col("STATUS") == SUCCESS)
    )
    return audit.agg(F.max("LAST_SOURCE_ID")).first()[0]


def rows_from(rows: DataFrame, column: str, place: int | None) -> DataFrame:
    """Rows whose cursor is at ``place`` or beyond; all rows for ``None``."""
    if place is None:
        return rows
    data_type = rows.schema[column].dataType
    return rows.where(F.col(quote_identifier(column)) >= cursor_literal(place, data_type))


def without_known(rows: DataFrame, known: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key is not among the known ones; a null in a key equals another."""
    names = [name.upper() for name in key]
    held = known.select(*(F.col(quote_identifier(n)).alias(f"held_{i}") for i, n in enumerate(names))).distinct()
    same = reduce(
        Column.__and__,
        (rows[quote_identifier(n)].eqNullSafe(held[f"held_{i}"]) for i, n in enumerate(names)),
    )
    return rows.join(held, same, "left_anti")


def sync_increment(
    source: Source, target: Target, table: str, cursor: Cursor, options: SyncOptions = SyncOptions()
) -> dict:
    """Load what is new in one table, and record it. A failure leaves the table and its mark as they were."""
    start = options.clock()
    ensure_audit_table(target)
    result = new_result(table)
    mark = None
    try:
        mark = high_water(target, table)
        target.check_name(table)
        columns = source.columns(table)
        moment = options.load_ts or options.clock()
        again = None if mark is None else mark - cursor.overlap
        read = rows_from(source.read(table), cursor.column, again)
        rows = project(read, columns, moment, options.projection)
        if target.exists(table):
            known = rows_from(target.read(table), cursor.column.upper(), again)
            rows = without_known(rows, known, cursor.key)
        loaded, reached = write_increment(rows, target, table, cursor, options)
        result |= {"rows_loaded": loaded.written, "expected_count": loaded.written, "actual_count": loaded.stored}
        if loaded.written == loaded.stored:
            publish_increment(rows, target, table, loaded)
            mark = max((m for m in (mark, reached) if m is not None), default=None)
            result |= {"status": SUCCESS, "rows_validated": loaded.stored}
        else:
            delete_folder(target.spark, loaded.folder)
            result |= {"status": VALIDATION_FAILED, "error": VALIDATION_MESSAGE}
    except Exception as error:
        result |= {"status": ERROR, "error": error_text(error)}
        log.error("increment of %s failed: %s", table, result["error"])
    fixed = options.load_ts
    record = audit_record(result, source.schema, fixed or start, fixed or options.clock())
    append_audit(target, [record | {"LOAD_TYPE": INCREMENTAL, "LAST_SOURCE_ID": mark}])
    return result


@dataclass(frozen=True)
class Increment:
    load_id: str
    folder: str
    written: int
    stored: int


def write_increment(
    rows: DataFrame, target: Target, table: str, cursor: Cursor, options: SyncOptions
) -> tuple[Increment, int | None]:
    """The increment in a folder of its own, and the furthest cursor in it.

    Rows are counted as they are written and again from what is stored.
    """
    spark = target.spark
    load_id = uuid.uuid4().hex
    folder = f"{target.folder}/{FOLDERS}/{table.lower()}/{LOAD_ID}={load_id}"
    counted = Observation()
    try:
        observed = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        observed.write.options(**{**WRITE_OPTIONS, **options.write_options}).parquet(folder)
        stored = spark.read.schema(rows.schema).parquet(folder)
        name = cursor.column.upper()
        place = position(F.col(quote_identifier(name)), rows.schema[name].dataType)
        found = stored.agg(F.count(F.lit(1)).alias("n"), F.max(place).alias("reached")).first()
    except Exception:
        delete_folder(spark, folder)
        raise
    return Increment(load_id, folder, counted.get["rows"], found["n"]), found["reached"]


def publish_increment(rows: DataFrame, target: Target, table: str, loaded: Increment) -> None:
    """Make the folder a partition of the table: one catalog operation. An empty increment is dropped."""
    spark, name = target.spark, target.name(table)
    if not target.exists(table):
        fields = ", ".join(
            f"{quote_identifier(f.name)} {f.dataType.simpleString()}" for f in rows.schema.fields
        )
        base = loaded.folder.rsplit("/", 1)[0].replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({fields}, {LOAD_ID} string) USING parquet"
            f" PARTITIONED BY ({LOAD_ID}) LOCATION '{base}'"
        )
    if not loaded.stored:
        delete_folder(spark, loaded.folder)
        return
    location = loaded.folder.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} ADD PARTITION ({LOAD_ID} = '{loaded.load_id}') LOCATION '{location}'")
    spark.catalog.refreshTable(name)
