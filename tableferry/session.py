"""Session settings and the shared storage root."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A full copy is one map-only pass; larger splits mean fewer tasks and fewer, larger files.
    "spark.sql.files.maxPartitionBytes": "512m",
    # The stamp as a plain 64-bit column, with statistics to filter on.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Tables loaded side by side share the executors instead of queueing behind the first one.
    "spark.scheduler.mode": "FAIR",
}

_conf_lock = threading.RLock()


def build_session(app_name: str = "tableferry", master: str | None = None, **settings: str):
    """Session with the settings above; ``settings`` (dots as ``__``) override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = {**SESSION_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]):
    """Hold session settings for the duration of a block (short: callers are serialised)."""
    with _conf_lock:
        before = {key: spark.conf.get(key, None) for key in settings}
        try:
            for key, value in settings.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)
