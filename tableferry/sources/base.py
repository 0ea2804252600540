"""What a source has to offer: names, columns and rows, all as DataFrames."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.frames import small_frame
from tableferry.functions.types import SourceColumn, source_type_of

LISTING_SCHEMA = T.StructType(
    [T.StructField("table_name", T.StringType()), T.StructField("table_type", T.StringType())]
)
COLUMN_CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("source_type", T.StringType()),
    ]
)
BASE_TABLE = "BASE TABLE"
VIEW = "VIEW"


def count_rows(df: DataFrame) -> DataFrame:
    """One row, ``row_count``. No column is needed, so parquet answers from the file footers."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


class Source(ABC):
    """A set of named tables."""

    #: name written to the audit as the source schema
    schema: str = "public"

    #: tables counted by one query; keeps its plan small in a schema of thousands
    counts_per_query: int = 200

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def check(self) -> None:
        """Raise if the source cannot be reached."""

    def refresh(self) -> None:
        """Forget what was learnt about the tables; called when a run starts."""

    def columns(self, table: str) -> list[SourceColumn]:
        """Columns of one table in ordinal order."""
        return introspect_columns(self, [table]).get(table, [])

    @abstractmethod
    def listing(self) -> DataFrame:
        """``(table_name, table_type)`` of every table and view."""

    @abstractmethod
    def column_catalog(self, tables: Iterable[str]) -> DataFrame:
        """``(table_name, ordinal, column_name, source_type)`` of the given tables."""

    @abstractmethod
    def read(self, table: str) -> DataFrame:
        """All rows and columns of a table; nothing is read before an action."""

    def waves(self, table: str) -> list[Callable[[], DataFrame]]:
        """The table in disjoint parts, written one after another; together they are :meth:`read`.

        A part is opened only when its turn comes, and again if its write has to be repeated.
        """
        return [partial(self.read, table)]

    @contextmanager
    def snapshot(self, table: str) -> Iterator[None]:
        """While it lasts, all reads of this thread see one state of the table, if the source can."""
        yield

    def count(self, table: str) -> DataFrame:
        """One row, ``row_count``."""
        return count_rows(self.read(table))


class SchemaSource(Source):
    """Source whose column types follow from the Spark schema of each table.

    ``types`` declares source types the schema cannot show, such as JSON held as text:
    ``{"events": {"props": "jsonb"}}``.
    """

    def __init__(
        self,
        spark: SparkSession,
        schema: str = "public",
        types: Mapping[str, Mapping[str, str]] | None = None,
    ):
        super().__init__(spark)
        self.schema = schema
        self.types = {table: dict(columns) for table, columns in (types or {}).items()}

    def columns(self, table: str) -> list[SourceColumn]:
        declared = self.types.get(table, {})
        return [
            SourceColumn(field.name, declared.get(field.name, source_type_of(field.dataType)))
            for field in self.read(table).schema.fields
        ]

    def column_catalog(self, tables: Iterable[str]) -> DataFrame:
        rows = [
            (table, ordinal, column.name, column.source_type)
            for table in tables
            for ordinal, column in enumerate(self.columns(table), start=1)
        ]
        return small_frame(self.spark, rows, COLUMN_CATALOG_SCHEMA)


def discover_tables(
    source: Source, exclude: Iterable[str] = (), base_tables_only: bool = False
) -> DataFrame:
    """Names and types of the tables to process, sorted by name."""
    listing = source.listing()
    if base_tables_only:
        listing = listing.filter(F.col("table_type") == BASE_TABLE)
    excluded = sorted(exclude)
    if excluded:
        listing = listing.filter(~F.col("table_name").isin(excluded))
    return listing.orderBy("table_name")


def table_names(
    source: Source, exclude: Iterable[str] = (), base_tables_only: bool = False
) -> list[str]:
    """:func:`discover_tables` as a list for the driver loop."""
    frame = discover_tables(source, exclude, base_tables_only)
    return [row.table_name for row in frame.collect()]


def open_counts(source: Source, tables: Sequence[str], workers: int = 8) -> dict[str, DataFrame]:
    """:meth:`Source.count` per table. Opening a table reads its schema, so several are opened at
    the same time."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return dict(zip(tables, pool.map(source.count, tables)))


def introspect_columns(source: Source, tables: Iterable[str]) -> dict[str, list[SourceColumn]]:
    """Columns of each table in ordinal order, from the column catalog."""
    columns: dict[str, list[SourceColumn]] = defaultdict(list)
    catalog = source.column_catalog(list(tables)).orderBy("table_name", "ordinal")
    for row in catalog.collect():
        columns[row.table_name].append(SourceColumn(row.column_name, row.source_type))
    return dict(columns)
