"""Folders on whatever file system a path names (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, location: str, missing_ok: bool = False) -> list[str]:
    """Names directly under a folder, sorted; hidden names left out."""
    path, file_system = _path(spark, location)
    if missing_ok and not file_system.exists(path):
        return []
    names = (status.getPath().getName() for status in file_system.listStatus(path))
    return sorted(name for name in names if not name.startswith(("_", ".")))


def delete_folder(spark: SparkSession, location: str) -> None:
    path, file_system = _path(spark, location)
    file_system.delete(path, True)


def is_inside(location: str, root: str) -> bool:
    """Whether a location lies below a root, whatever way the scheme is spelled."""
    return _plain(location).startswith(_plain(root) + "/")


def same_place(location: str, other: str) -> bool:
    return _plain(location) == _plain(other)


def _plain(location: str) -> str:
    scheme, separator, rest = location.partition(":")
    if separator and scheme == "file":
        location = "/" + rest.lstrip("/")
    return location.rstrip("/")
