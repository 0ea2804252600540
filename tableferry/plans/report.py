"""Run summary and report text from table results.

The results hold one row per table, so the lists collected here are as long as the catalog.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.functions.formats import duration_text
from tableferry.plans.status import CRITICAL_FAILURE, FAILURE, PIPELINE_LEVEL, SUCCESS


def is_success() -> Column:
    return F.col("status") == SUCCESS


def failed(results: DataFrame) -> DataFrame:
    return results.filter(~is_success())


def succeeded(results: DataFrame) -> DataFrame:
    return results.filter(is_success())


def run_status(failures: Column, tables: int, critical_error: str | None = None) -> Column:
    """A run succeeds if it had at least one table and none failed."""
    if critical_error is not None:
        return F.lit(CRITICAL_FAILURE)
    return F.when((failures == 0) & F.lit(tables > 0), SUCCESS).otherwise(FAILURE)


def failed_tables() -> Column:
    """The failed tables with their errors, by name."""
    failure = F.struct(F.col("table"), F.coalesce("error", F.lit("Unknown")).alias("error"))
    return F.sort_array(F.collect_list(F.when(~is_success(), failure)))


def run_summary(
    results: DataFrame, tables: int, duration: float, critical_error: str | None = None
) -> DataFrame:
    """One row: status, counts of tables, total rows, failed tables, duration."""
    totals = results.agg(
        F.count_if(is_success()).cast("int").alias("successes"),
        F.count_if(~is_success()).cast("int").alias("failures"),
        F.coalesce(F.sum(F.coalesce("rows_loaded", F.lit(0))), F.lit(0)).alias("total_rows"),
        failed_tables().alias("failed_tables"),
    )
    failed_list = F.col("failed_tables")
    if critical_error is not None:
        pipeline = F.struct(
            F.lit(PIPELINE_LEVEL).alias("table"), F.lit(critical_error).alias("error")
        )
        failed_list = F.concat(failed_list, F.array(pipeline))
    return totals.select(
        run_status(F.col("failures"), tables, critical_error).alias("status"),
        F.lit(tables).alias("tables_processed"),
        "successes",
        "failures",
        "total_rows",
        failed_list.alias("failed_tables"),
        F.lit(float(duration)).alias("duration"),
    )


def failure_line(source_label: str = "PG", target_label: str = "SNOW") -> Column:
    """Report line of a failed table; the counts only when both are known."""
    error = F.coalesce("error", F.lit("Unknown error"))
    counts = F.format_string(
        f" ({source_label}: %d -> {target_label}: %d)", "expected_count", "actual_count"
    )
    both_known = F.col("expected_count").isNotNull() & F.col("actual_count").isNotNull()
    return F.concat(
        quoted_name(),
        F.lit(" - "),
        error,
        F.when(both_known, counts).otherwise(""),
        F.lit("\n"),
    )


def quoted_name() -> Column:
    return F.concat(F.lit("`"), F.col("table"), F.lit("`"))


def run_report(
    results: DataFrame,
    tables: int,
    title: str,
    moment: datetime,
    duration: float,
    critical_error: str | None = None,
) -> DataFrame:
    """One row, one column ``report``: title line, failures, successes, tables in name order."""
    stamp = moment.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC")
    line = F.struct(F.col("table"), failure_line().alias("line"))
    sections = results.agg(
        F.count_if(~is_success()).alias("n_failed"),
        F.count_if(is_success()).alias("n_succeeded"),
        F.sort_array(F.collect_list(F.when(~is_success(), line))).alias("failed"),
        F.sort_array(F.collect_list(F.when(is_success(), quoted_name()))).alias("succeeded"),
    )
    status = run_status(F.col("n_failed"), tables, critical_error)
    header = F.concat(
        F.lit(f"{title}: "),
        F.when(status == SUCCESS, "Sync Completed").otherwise("Sync Failed"),
        F.lit(f" | {stamp} | "),
        duration_text(F.lit(float(duration))),
        F.lit("\n\n"),
    )
    failures = F.concat(
        F.format_string("* Failures (%d)*\n", "n_failed"),
        F.array_join("failed.line", ""),
        F.lit("\n"),
    )
    successes = F.concat(
        F.format_string("* Successes (%d)*\n", "n_succeeded"),
        F.array_join("succeeded", " "),
        F.lit("\n"),
    )
    return sections.select(
        F.concat(
            header,
            F.when(F.col("n_failed") > 0, failures).otherwise(""),
            F.when(F.col("n_succeeded") > 0, successes).otherwise(""),
        ).alias("report")
    )
