"""A load whose tasks fail on their first attempt; run by test_task_retry in its own JVM."""

import sys
from datetime import datetime, timezone

from pyspark import TaskContext

from tableferry import FrameSource, SyncOptions, Target, build_session, sync_table


def fail_once(batches):
    for batch in batches:
        yield batch
    # Rows were already handed on when the attempt fails.
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("executor lost")


def main(root: str) -> None:
    spark = build_session(
        "retry", "local[4,3]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("OFF")
    rows = spark.range(0, 100_000, 1, 8).mapInPandas(fail_once, "id long")
    target = Target(spark, "ods_retry", root).ensure()
    options = SyncOptions(load_ts=datetime(2024, 1, 1, tzinfo=timezone.utc), write_attempts=1)
    result = sync_table(FrameSource(spark, {"t": rows}), target, "t", options)
    stored = target.read("t")
    print("RESULT", result["status"], result["rows_loaded"], result["actual_count"], stored.distinct().count())
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
