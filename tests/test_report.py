from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tableferry.frames import small_frame
from tableferry.functions.formats import duration_text
from tableferry.plans.report import failed, run_report, run_summary, succeeded
from tableferry.plans.sync import RESULT_SCHEMA

NOON = datetime(2024, 5, 6, 12, 0, 1, tzinfo=timezone.utc)
RESULTS = [
    ("d_crash", "CRASHED", None, None, None, None, None),
    ("b_ok", "SUCCESS", 5, 5, 5, 5, None),
    ("c_bad", "VALIDATION_FAILED", 7, 0, 7, 6, "Count or type validation failed"),
    ("a_ok", "SUCCESS", 10, 10, 10, 10, None),
    ("e_conn", "CONNECTION_ERROR", None, None, None, None, "refused"),
    ("f_err", "ERROR", 0, 0, 0, 0, "boom"),
]


def results(spark, rows):
    return small_frame(spark, rows, RESULT_SCHEMA)


def text(spark, rows, **kwargs):
    kwargs = {"tables": len(rows), "title": "Copy", "moment": NOON, "duration": 61.9, **kwargs}
    return run_report(results(spark, rows), **kwargs).first().report


def test_report_with_failures(spark):
    assert text(spark, RESULTS) == (
        "Copy: Sync Failed | 2024-05-06 12:00:01 UTC | 1m 1s\n\n"
        "* Failures (4)*\n"
        "`c_bad` - Count or type validation failed (PG: 7 -> SNOW: 6)\n"
        "`d_crash` - Unknown error\n"
        "`e_conn` - refused\n"
        "`f_err` - boom (PG: 0 -> SNOW: 0)\n"
        "\n"
        "* Successes (2)*\n`a_ok` `b_ok`\n"
    )


def test_report_of_a_good_run(spark):
    rows = [r for r in RESULTS if r[1] == "SUCCESS"]
    assert text(spark, rows) == (
        "Copy: Sync Completed | 2024-05-06 12:00:01 UTC | 1m 1s\n\n* Successes (2)*\n`a_ok` `b_ok`\n"
    )


def test_report_of_only_failures(spark):
    report = text(spark, [RESULTS[-1]])
    assert report.endswith("* Failures (1)*\n`f_err` - boom (PG: 0 -> SNOW: 0)\n\n")


def test_report_stamp_is_utc(spark):
    moment = NOON.astimezone(timezone(timedelta(hours=9)))
    assert "| 2024-05-06 12:00:01 UTC |" in text(spark, [RESULTS[1]], moment=moment)


def test_title_follows_the_status(spark):
    assert text(spark, []).startswith("Copy: Sync Failed")
    assert text(spark, [RESULTS[1]], critical_error="down").startswith("Copy: Sync Failed")


def test_summary(spark):
    row = run_summary(results(spark, RESULTS), 6, 2.5).first()
    assert (row.status, row.tables_processed, row.successes, row.failures, row.total_rows, row.duration) == (
        "FAILURE", 6, 2, 4, 22, 2.5,
    )
    assert [tuple(f) for f in row.failed_tables] == [
        ("c_bad", "Count or type validation failed"),
        ("d_crash", "Unknown"),
        ("e_conn", "refused"),
        ("f_err", "boom"),
    ]


def test_summary_of_a_critical_failure(spark):
    row = run_summary(results(spark, []), 0, 0.0, "no source").first()
    assert (row.status, row.failures) == ("CRITICAL_FAILURE", 0)
    assert [tuple(f) for f in row.failed_tables] == [("Pipeline Level", "no source")]


def test_split_by_status(spark):
    frame = results(spark, RESULTS)
    assert (failed(frame).count(), succeeded(frame).count()) == (4, 2)


@pytest.mark.parametrize("seconds, expected", [(0.0, "0m 0s"), (59.999, "0m 59s"), (60.0, "1m 0s"), (7325.5, "122m 5s")])
def test_duration(spark, seconds, expected):
    assert spark.range(1).select(duration_text(F.lit(seconds))).first()[0] == expected
