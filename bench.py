"""Headline workloads, timed; prints one JSON line.

Each workload runs once to warm the JVM, then ``BENCH_RUNS`` times; the median counts. Loads write
real tables under the shared folder and are dropped at the end.
"""

from __future__ import annotations

import json
import os
import statistics
import time
import uuid

from pyspark.sql import DataFrame

from tableferry import (
    ParquetSource,
    SyncOptions,
    Target,
    build_session,
    catalog_profile,
    reconcile,
    shared_root,
    sync_all,
    sync_table,
    with_row_hash,
)
from tableferry.operators.counts import count_tables
from tableferry.operators.messages import purge_counts
from tableferry.registry.queries import PHRASES, TABLES
from tableferry.sources import open_counts
from tableferry.storage import delete_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def must(result: dict) -> None:
    if result["status"] != "SUCCESS":
        raise RuntimeError(f"{result['table']}: {result['error']}")


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=CPUS,
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = f"{shared_root(spark)}/tableferry/bench-{uuid.uuid4().hex[:8]}"
    target = Target(spark, "bench_single", root).ensure()
    whole = Target(spark, "bench_whole", root).ensure()

    def source() -> ParquetSource:
        return ParquetSource(spark, SF_DIR, types={"events": {"props": "jsonb"}})

    def load(table: str):
        return lambda: must(sync_table(source(), target, table))

    def sync(workers: int):
        def action() -> None:
            for result in sync_all(source(), whole, SyncOptions(workers=workers)).results:
                must(result)

        return action

    def row_hash(table: str):
        def action() -> None:
            tables = source()
            consume(with_row_hash(tables.read(table), tables.columns(table)).select("ROW_HASH"))

        return action

    workloads = {
        "load_lineitem": load("lineitem"),
        "load_events_variant": load("events"),
        "load_orders": load("orders"),
        "sync_all_1_worker": sync(1),
        "sync_all_4_workers": sync(4),
        "row_counts": lambda: consume(count_tables(spark, open_counts(source(), TABLES))),
        "reconcile": lambda: consume(reconcile(source(), whole)[0]),
        "catalog_profile": lambda: consume(catalog_profile(spark, [whole.schema])),
        "row_hash_orders": row_hash("orders"),
        "row_hash_lineitem": row_hash("lineitem"),
        "purge_counts": lambda: consume(purge_counts(source().read("conversations"), PHRASES)),
    }
    first, timed = {}, {}
    for name, action in workloads.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            action()
            times.append(time.perf_counter() - start)
        first[name] = round(times[0], 3)
        timed[name] = round(statistics.median(times[1:]), 3)
    rows = sum(r.row_count for r in count_tables(spark, open_counts(source(), TABLES)).collect())
    target.drop_schema()
    whole.drop_schema()
    delete_folder(spark, root)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "first_run": first,
                "rows_per_sec_sync_all": round(rows / timed["sync_all_4_workers"]),
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
