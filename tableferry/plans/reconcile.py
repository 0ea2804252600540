"""Source and target row counts side by side."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.frames import small_frame
from tableferry.functions.formats import count_line, diff_line, reconcile_line, totals_line
from tableferry.operators.counts import COUNT_SCHEMA, source_counts, target_counts
from tableferry.operators.target import Target
from tableferry.sources import CatalogSource, Source, table_names

log = logging.getLogger(__name__)


def compare_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Every source table with its target count, if there is one; names match in any case.

    Columns: ``table_name, source_count, target_count, is_mismatch, diff, target_missing``.
    A missing target is a mismatch with difference 0.
    """
    left, right = source.alias("s"), target.alias("t")
    same = F.upper("s.table_name") == F.upper("t.table_name")
    source_count, target_count = F.col("s.row_count"), F.col("t.row_count")
    return left.join(right, same, "left").select(
        F.col("s.table_name").alias("table_name"),
        source_count.alias("source_count"),
        target_count.alias("target_count"),
        (~source_count.eqNullSafe(target_count)).alias("is_mismatch"),
        F.when(target_count.isNull(), 0).otherwise(target_count - source_count).alias("diff"),
        target_count.isNull().alias("target_missing"),
    )


def count_totals(details: DataFrame) -> DataFrame:
    """One row: totals of both sides (missing targets add nothing) and number of mismatches."""
    return details.agg(
        F.count(F.lit(1)).alias("tables"),
        F.coalesce(F.sum("source_count"), F.lit(0)).alias("source_total"),
        F.coalesce(F.sum("target_count"), F.lit(0)).alias("target_total"),
        F.count_if("is_mismatch").alias("mismatches"),
    )


def mismatches(details: DataFrame) -> DataFrame:
    return details.filter("is_mismatch").select(
        "table_name", "source_count", "target_count", "diff"
    )


def reconcile(
    source: Source, target: Target | Source, exclude: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(details, totals)`` for the base tables of a source.

    The target is a target schema, or anything that can be a source, such as another database.
    Each table of either side is counted once. If the target cannot be reached at all, its counts
    are all missing and the source side is still reported.
    """
    spark = source.spark
    tables = table_names(source, exclude, base_tables_only=True)
    counted = source_counts(source, tables)
    stored_in = CatalogSource(spark, target.schema) if isinstance(target, Target) else target
    try:
        stored_in.check()
        stored = target_counts(stored_in, tables)
    except Exception as error:
        log.warning("target not reachable, source side only: %s", error)
        stored = small_frame(spark, [], COUNT_SCHEMA)
    details = compare_counts(counted, stored)
    return details, count_totals(details)


def source_lines(details: DataFrame) -> DataFrame:
    """``(table_name, line)``: source counts as fixed-width text."""
    line = count_line(F.col("table_name"), F.col("source_count"))
    return details.select("table_name", line.alias("line"))


def reconcile_lines(details: DataFrame) -> DataFrame:
    """``(table_name, line)``: both counts as fixed-width text with a match mark."""
    line = reconcile_line(
        F.col("table_name"), F.col("source_count"), F.col("target_count"), ~F.col("is_mismatch")
    )
    return details.select("table_name", line.alias("line"))


def mismatch_lines(details: DataFrame) -> DataFrame:
    """``(table_name, line)``: signed differences of the mismatches."""
    line = diff_line(F.col("table_name"), F.col("diff"))
    return mismatches(details).select("table_name", line.alias("line"))


def total_line(totals: DataFrame) -> DataFrame:
    line = totals_line(F.col("source_total"), F.col("target_total"))
    return totals.select(line.alias("line"))
