"""Row counts of many tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.frames import small_frame
from tableferry.sources.base import Source, open_counts

log = logging.getLogger(__name__)

COUNT_SCHEMA = "table_name string, row_count bigint"


def count_tables(spark: SparkSession, counts: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` from one-row counts, evaluated side by side in one query."""
    named = [
        count.select(F.lit(name).alias("table_name"), "row_count") for name, count in counts.items()
    ]
    if not named:
        return small_frame(spark, [], COUNT_SCHEMA)
    return reduce(DataFrame.unionAll, named)


def collect_counts(
    spark: SparkSession, counts: Mapping[str, DataFrame], per_query: int = Source.counts_per_query
) -> dict[str, int]:
    """:func:`count_tables` evaluated, a bounded number of tables at a time."""
    names = list(counts)
    known: dict[str, int] = {}
    for start in range(0, len(names), per_query):
        chunk = {name: counts[name] for name in names[start : start + per_query]}
        known |= {r.table_name: r.row_count for r in count_tables(spark, chunk).collect()}
    return known


def source_counts(source: Source, tables: Iterable[str]) -> DataFrame:
    """Counts of source tables; a table that cannot be read is an error."""
    counts = open_counts(source, list(tables))
    known = collect_counts(source.spark, counts, source.counts_per_query)
    return small_frame(source.spark, list(known.items()), COUNT_SCHEMA)


def target_counts(target: Source, tables: Iterable[str]) -> DataFrame:
    """Counts of target tables; one that is missing or cannot be read has no count.

    The names asked for are matched in any case, and each target table is counted once.
    """
    wanted = {table.upper() for table in tables}
    counts = {}
    for row in target.listing().collect():
        if row.table_name.upper() in wanted:
            count = _lenient(row.table_name, lambda: target.count(row.table_name))
            if count is not None:
                counts[row.table_name] = count
    try:
        known = collect_counts(target.spark, counts, target.counts_per_query)
    except Exception as error:
        # One unreadable table must not hide the others: count them one by one.
        log.warning("counting together failed, going on table by table: %s", error)
        known = {}
        for table, count in counts.items():
            value = _lenient(table, lambda: count.first().row_count)
            if value is not None:
                known[table] = value
    return small_frame(target.spark, list(known.items()), COUNT_SCHEMA)


def _lenient(table: str, action: Callable):
    try:
        return action()
    except Exception as error:
        log.warning("no count for %s: %s", table, error)
        return None
