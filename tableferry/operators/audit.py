"""The load audit: one row per attempted table and run."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.frames import small_frame
from tableferry.operators.target import Target

AUDIT_TABLE = "etl_metadata"
FULL_LOAD = "FULL_LOAD"

# Columns of the audit table.
AUDIT_COLUMNS = """
    TABLE_NAME string,
    SOURCE_SCHEMA string,
    LOAD_TYPE string,
    ROWS_LOADED bigint,
    ROWS_VALIDATED bigint,
    LOAD_START timestamp,
    LOAD_END timestamp,
    LOADED_AT_UTC timestamp,
    LAST_SOURCE_ID bigint,
    ROW_HASH string,
    STATUS string,
    ERROR_MESSAGE string
"""
AUDIT_KEY = ("TABLE_NAME", "LOAD_START")


def ensure_audit_table(target: Target) -> None:
    """Create the audit table if it is not there."""
    name = target.name(AUDIT_TABLE)
    target.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({AUDIT_COLUMNS}) USING parquet")


def append_audit(target: Target, records: Iterable[dict]) -> None:
    """Append the records of a run as one file. The two columns nothing fills stay NULL."""
    rows = small_frame(target.spark, list(records), AUDIT_COLUMNS)
    rows.coalesce(1).write.mode("append").insertInto(target.name(AUDIT_TABLE))


def audit_record(result: dict, source_schema: str, load_start, load_end) -> dict:
    """Audit row of a table result; both end stamps are the same instant."""
    return {
        "TABLE_NAME": result["table"],
        "SOURCE_SCHEMA": source_schema,
        "LOAD_TYPE": FULL_LOAD,
        "ROWS_LOADED": result["rows_loaded"] or 0,
        "ROWS_VALIDATED": result["rows_validated"] or 0,
        "LOAD_START": load_start,
        "LOAD_END": load_end,
        "LOADED_AT_UTC": load_end,
        "STATUS": result["status"],
        "ERROR_MESSAGE": result["error"],
    }


def duplicate_audit_keys(audit: DataFrame) -> DataFrame:
    """Keys recorded more than once; empty when the audit is sound."""
    counted = audit.groupBy(*AUDIT_KEY).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)
