"""Parquet directories, catalog schemas and plain DataFrames as sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tableferry.catalog import base_tables, views
from tableferry.frames import small_frame
from tableferry.functions.projection import quote_identifier
from tableferry.sources.base import BASE_TABLE, LISTING_SCHEMA, VIEW, SchemaSource
from tableferry.storage import list_names

PARQUET = ".parquet"


class ParquetSource(SchemaSource):
    """Every ``<table>.parquet`` (one file, or a directory of files) under a folder."""

    def __init__(self, spark: SparkSession, path: str, schema: str = "public", types=None):
        super().__init__(spark, schema, types)
        self.path = str(path).rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def check(self) -> None:
        list_names(self.spark, self.path)

    def refresh(self) -> None:
        self._frames.clear()

    def listing(self) -> DataFrame:
        names = list_names(self.spark, self.path)
        rows = [(n[: -len(PARQUET)], BASE_TABLE) for n in names if n.endswith(PARQUET)]
        return small_frame(self.spark, rows, LISTING_SCHEMA)

    def read(self, table: str) -> DataFrame:
        # Schema and file list are read once per table and run.
        if table not in self._frames:
            self._frames[table] = self.spark.read.parquet(f"{self.path}/{table}{PARQUET}")
        return self._frames[table]


class CatalogSource(SchemaSource):
    """Tables and views of one schema of the session catalog."""

    def __init__(self, spark: SparkSession, schema: str, types=None):
        super().__init__(spark, schema, types)

    def check(self) -> None:
        self.spark.catalog.getDatabase(self.schema)

    def listing(self) -> DataFrame:
        rows = [(name, BASE_TABLE) for name in base_tables(self.spark, self.schema)]
        rows += [(name, VIEW) for name in views(self.spark, self.schema)]
        return small_frame(self.spark, rows, LISTING_SCHEMA)

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"{quote_identifier(self.schema)}.{quote_identifier(table)}")


class FrameSource(SchemaSource):
    """Named DataFrames."""

    def __init__(
        self, spark: SparkSession, frames: Mapping[str, DataFrame], schema: str = "public", types=None
    ):
        super().__init__(spark, schema, types)
        self.frames = dict(frames)

    def listing(self) -> DataFrame:
        return small_frame(self.spark, [(n, BASE_TABLE) for n in self.frames], LISTING_SCHEMA)

    def read(self, table: str) -> DataFrame:
        return self.frames[table]
