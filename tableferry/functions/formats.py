"""Text formats of the report, the reconciliation and the profile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_text(seconds: Column) -> Column:
    """Whole minutes and seconds, truncated: ``61.9`` is ``1m 1s``."""
    whole = F.floor(seconds).cast("bigint")
    return F.format_string("%dm %ds", F.floor(whole / 60).cast("bigint"), whole % 60)


def match_mark(is_match: Column) -> Column:
    return F.when(is_match, "✓").otherwise("✗")


def backup_suffix(moment) -> str:
    """Suffix of a backup table, from a Python timestamp."""
    return moment.strftime("%Y%m%d_%H%M%S")


# The formats of the lines below.


def count_line(table: Column, count: Column) -> Column:
    return F.format_string("%-40s | %10d", table, count)


def reconcile_line(table: Column, source: Column, target: Column, is_match: Column) -> Column:
    found = F.coalesce(target.cast("string"), F.lit("NOT FOUND"))
    return F.format_string(
        "%s %-40s | PG: %10d | SF: %-10s", match_mark(is_match), table, source, found
    )


def diff_line(table: Column, diff: Column) -> Column:
    return F.format_string("  %-40s | Diff: %+10d", table, diff)


def totals_line(source: Column, target: Column) -> Column:
    return F.format_string("TOTALS: PostgreSQL: %10d | Snowflake: %10d", source, target)
