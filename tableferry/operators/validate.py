"""Checks on a staging table before it is published."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.frames import small_frame
from tableferry.functions.types import SourceColumn, json_columns, target_type_of
from tableferry.operators.target import Target

MISSING = "MISSING"


@dataclass(frozen=True)
class CountCheck:
    ok: bool
    expected: int
    actual: int


def count_stored(target: Target, table: str) -> int:
    """Count the rows of a stored table and keep the count in the catalog.

    ``ANALYZE TABLE`` counts independently of the write (from the parquet footers) and leaves the
    statistics there for the planner and for the catalog profile.
    """
    target.spark.sql(f"ANALYZE TABLE {target.name(table)} COMPUTE STATISTICS")
    count = stored_row_count(target, table)
    return target.read(table).count() if count is None else count


def stored_row_count(target: Target, table: str) -> int | None:
    """Row count the catalog already knows, without looking at the table."""
    return (target.describe(table).get("statistics") or {}).get("num_rows")


def validate_count(expected: int, target: Target, table: str) -> CountCheck:
    """Rows written against rows stored."""
    actual = count_stored(target, table)
    return CountCheck(expected == actual, expected, actual)


def target_column_catalog(target: Target, table: str) -> DataFrame:
    """``(column_name, data_type)`` of a stored table, types by their target name."""
    fields = target.read(table).schema.fields
    rows = [(field.name, target_type_of(field.dataType)) for field in fields]
    return small_frame(target.spark, rows, "column_name string, data_type string")


def check_json_types(
    spark: SparkSession,
    table: str,
    columns: Sequence[SourceColumn],
    stored: DataFrame,
) -> DataFrame:
    """One row per JSON column of the source: ``(table_name, column_name, actual_type, ok)``."""
    catalog = small_frame(
        spark,
        [(column.name, column.source_type) for column in columns],
        "column_name string, source_type string",
    )
    wanted = json_columns(catalog).alias("wanted")
    found = stored.alias("found")
    same_name = F.upper("wanted.column_name") == F.upper("found.column_name")
    actual = F.coalesce("found.data_type", F.lit(MISSING))
    return wanted.join(found, same_name, "left").select(
        F.lit(table).alias("table_name"),
        F.col("wanted.column_name").alias("column_name"),
        actual.alias("actual_type"),
        (actual == "VARIANT").alias("ok"),
    )


def json_types_ok(target: Target, stored_table: str, columns: Sequence[SourceColumn]) -> bool:
    """Whether every JSON column is stored as VARIANT; true if there is none."""
    if not any(column.is_json for column in columns):
        return True
    stored = target_column_catalog(target, stored_table)
    checks = check_json_types(target.spark, stored_table, columns, stored)
    return checks.filter(~F.col("ok")).isEmpty()
