"""A database schema over JDBC."""

from __future__ import annotations

import logging
import math
import re
import threading
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import closing, contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import partial, reduce
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tableferry.functions.projection import quote_identifier
from tableferry.functions.types import SourceColumn
from tableferry.sources.base import Source, introspect_columns

log = logging.getLogger(__name__)

# A database that lacks what page ranges are asked with (unknown function, or no such catalog
# table); any other error is one of the table.
_LACKING = re.compile(
    r"SQLSTATE:? ?\(?(42883|42P01)"
    r"|function \S*(pg_partition_tree|pg_relation_size|to_regclass)\b.* does not exist"
    r'|relation "?(pg_class|pg_namespace)"? does not exist',
    re.I,
)


def quote_name(name: str) -> str:
    """Double-quoted identifier for the source database, embedded quotes doubled."""
    return '"' + name.replace('"', '""') + '"'


@dataclass(frozen=True)
class Split:
    """How one table is read in parallel.

    ``predicates``: disjoint conditions that together cover the table; used as they are.
    ``column``: a key, best a unique and indexed one; the table is cut into about ``parts`` ranges
    of it with equally many rows (without ``parts``: as many as its row count asks for), however
    unevenly the values are spread. Rows of one key value stay together, so a key that repeats a
    lot calls for ``predicates``.
    With neither, a Postgres table or its partitions are cut into equal runs of pages; a view, or
    a table elsewhere, is read by one task.
    """

    parts: int | None = None
    column: str | None = None
    predicates: Sequence[str] = field(default_factory=tuple)


def page_predicates(pages: int, parts: int) -> list[str]:
    """Row-address ranges of about equal size: their width does not depend on any key's skew.

    The first and last range are open, so rows added while the table is read still fall in one.
    """
    parts = max(1, min(parts, pages))
    if parts == 1:
        return []
    bounds = [pages * i // parts for i in range(1, parts)]
    predicates = [f"ctid < '({bounds[0]},0)'::tid"]
    predicates += [
        f"ctid >= '({low},0)'::tid AND ctid < '({high},0)'::tid"
        for low, high in zip(bounds, bounds[1:])
    ]
    return predicates + [f"ctid >= '({bounds[-1]},0)'::tid"]


def sql_literal(value) -> str:
    """A key value as standard SQL."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def range_predicates(key: str, starts: Sequence, places: Sequence[int] | None = None) -> list[str]:
    """Disjoint ranges of a key that together cover a table, from the first key of each of its
    tiles. ``places``: where the database sorts each of them, equal ones in one place; without,
    they are sorted here, which is right for numbers, dates and instants, not for text. A key that starts several tiles gets a range of its own. Rows without a key, and keys
    below the first that turn up while the table is read, share the last range."""
    if places is None:
        counts = Counter(starts)
        bounds = sorted(counts)
    else:
        # One spelling for each place: keys that the database takes as equal share a range.
        spelled = dict(zip(places, starts, strict=True))
        bounds = [spelled[place] for place in sorted(spelled)]
        counts = Counter(spelled[place] for place in places)
    predicates = []
    for i, low in enumerate(bounds):
        literal = sql_literal(low)
        below = f" AND {key} < {sql_literal(bounds[i + 1])}" if i + 1 < len(bounds) else ""
        if counts[low] > 1:
            predicates += [f"{key} = {literal}", f"{key} > {literal}{below}"]
        else:
            predicates.append(f"{key} >= {literal}{below}")
    if predicates:
        predicates.append(f"{key} < {sql_literal(bounds[0])} OR {key} IS NULL")
    return predicates


class JdbcSource(Source):
    """All tables and views of a database schema that has an ``information_schema``.

    ``properties`` are Spark's JDBC options (user, password, driver, ...). A table is cut into pieces
    of about ``part_bytes`` (``part_rows`` where only rows are known), however many that makes, and
    read over at most ``max_connections`` connections at a time, whatever the size of the cluster:
    a load takes the pieces in waves of that many. A run with several workers reads that many times
    more.

    ``connect`` opens a DB-API connection to a Postgres database. With it a load reads one exported
    snapshot of its table over all connections; without, each connection sees its own moment.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        schema: str = "public",
        properties: Mapping[str, str] | None = None,
        splits: Mapping[str, Split] | None = None,
        fetch_size: int = 5000,
        part_bytes: int = 256 << 20,
        max_connections: int = 32,
        part_rows: int = 1_000_000,
        connect: Callable | None = None,
    ):
        super().__init__(spark)
        self.url = url
        self.schema = schema
        self.properties = dict(properties or {})
        self.splits = dict(splits or {})
        self.fetch_size = fetch_size
        self.part_bytes = part_bytes
        self.max_connections = max_connections
        self.part_rows = part_rows
        self.connect = connect
        self.counts_per_query = max_connections  # each count holds a connection
        self._local = threading.local()  # tables are loaded by one thread each
        self._columns: dict[str, list[SourceColumn]] | None = None
        self._columns_lock = threading.Lock()

    def options(self, **more: str) -> dict[str, str]:
        base = {"url": self.url, "fetchsize": str(self.fetch_size), "preferTimestampNTZ": "true"}
        made = {**base, **self.properties, **more}
        snapshot = getattr(self._local, "snapshot", None)
        if snapshot:
            # Only the first statement of a transaction can choose its snapshot.
            first = (
                "SET TRANSACTION ISOLATION LEVEL REPEATABLE READ;"
                f" SET TRANSACTION SNAPSHOT {sql_literal(snapshot)}"
            )
            given = made.get("sessionInitStatement")
            made["sessionInitStatement"] = f"{first}; {given}" if given else first
        return made

    @contextmanager
    def snapshot(self, table: str) -> Iterator[None]:
        if self.connect is None:
            yield
            return
        # A transaction that stays open keeps the snapshot for those who read by its name.
        with closing(self.connect()) as connection, closing(connection.cursor()) as cursor:
            cursor.execute("SET TRANSACTION ISOLATION LEVEL REPEATABLE READ, READ ONLY")
            cursor.execute("SELECT pg_export_snapshot()")
            self._local.snapshot = cursor.fetchone()[0]
            try:
                yield
            finally:
                self._local.snapshot = None
                connection.rollback()

    def _query(self, sql: str) -> DataFrame:
        return self._load(self.options(query=sql))

    def _load(self, options: Mapping[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(**options).load()

    def check(self) -> None:
        self._query("SELECT 1 AS ok").collect()

    def refresh(self) -> None:
        self._columns = None

    def columns(self, table: str) -> list[SourceColumn]:
        with self._columns_lock:
            if self._columns is None:
                self._columns = introspect_columns(self, [])
        return self._columns.get(table, [])

    def listing(self) -> DataFrame:
        tables = self._query(
            "SELECT table_schema, table_name, table_type FROM information_schema.tables"
        )
        return tables.filter(F.col("table_schema") == self.schema).select("table_name", "table_type")

    def column_catalog(self, tables: Iterable[str]) -> DataFrame:
        # One read covers all tables of the schema; the filter runs in the database.
        columns = self._query(
            "SELECT table_schema, table_name, ordinal_position, column_name, data_type"
            " FROM information_schema.columns"
        )
        return columns.filter(F.col("table_schema") == self.schema).select(
            "table_name",
            F.col("ordinal_position").cast("int").alias("ordinal"),
            "column_name",
            F.col("data_type").alias("source_type"),
        )

    def qualified(self, table: str) -> str:
        return f"{quote_name(self.schema)}.{quote_name(table)}"

    def read(self, table: str) -> DataFrame:
        pieces = self._pieces(table)
        whole = self._read_pieces(table, pieces)
        tasks = sum(max(1, len(predicates)) for _, predicates in pieces)
        return whole.coalesce(self.max_connections) if tasks > self.max_connections else whole

    def waves(self, table: str) -> list[Callable[[], DataFrame]]:
        # One entry a connection: a stored table, and a condition or all of it.
        flat = [(name, p) for name, predicates in self._pieces(table) for p in predicates or [None]]
        waves = []
        for start in range(0, len(flat), self.max_connections):
            pieces = [
                (name, [predicate for _, predicate in entries if predicate is not None])
                for name, entries in groupby(
                    flat[start : start + self.max_connections], key=lambda entry: entry[0]
                )
            ]
            waves.append(partial(self._read_pieces, table, pieces))
        return waves

    def _pieces(self, table: str) -> list[tuple[str, list[str]]]:
        """Stored tables with the conditions they are read by, one connection each."""
        split = self.splits.get(table, Split())
        name = self.qualified(table)
        if split.predicates:
            return [(name, list(split.predicates))]
        if split.column:
            return [(name, self._key_ranges(name, split))]
        if self.url.startswith("jdbc:postgresql:"):
            return self._page_ranges(name, split.parts)
        return [(name, [])]

    def _read_pieces(self, table: str, pieces: Sequence[tuple[str, list[str]]]) -> DataFrame:
        frames = [self._read_piece(*piece) for piece in pieces]
        if any(name != self.qualified(table) for name, _ in pieces):
            # Partitions may hold their columns in another order than the table.
            names = [quote_identifier(column.name) for column in self.columns(table)]
            frames = [frame.select(*names) for frame in frames]
        return reduce(DataFrame.unionAll, frames)

    def count(self, table: str) -> DataFrame:
        # Counted by the database: counting a read would send every row over the connection.
        counted = self._query(f"SELECT COUNT(*) AS row_count FROM {self.qualified(table)}")
        return counted.select(F.col(counted.columns[0]).cast("bigint").alias("row_count"))

    def _read_piece(self, name: str, predicates: list[str]) -> DataFrame:
        if not predicates:
            return self._load(self.options(dbtable=name))
        properties = self.options()
        url = properties.pop("url")
        return self.spark.read.jdbc(url, name, predicates=predicates, properties=properties)

    def _key_ranges(self, name: str, split: Split) -> list[str]:
        # The database cuts the sorted keys into tiles of equal size; one row per tile comes back.
        key = quote_name(split.column)
        parts = split.parts
        if parts is None:
            counted = self._query(f"SELECT COUNT(*) AS row_count FROM {name}").first()[0]
            parts = max(1, math.ceil(int(counted) / self.part_rows))
        tiles = (
            f" FROM (SELECT {key} AS k, NTILE({parts}) OVER (ORDER BY {key})"
            f" AS tile FROM {name} WHERE {key} IS NOT NULL) t GROUP BY tile"
        )
        starts = self._query(f"SELECT MIN(k) AS start{tiles}")
        if isinstance(starts.schema[0].dataType, StringType):
            # How text is sorted, and what is equal, is the collation's to say.
            rows = self._query(
                f"SELECT start, DENSE_RANK() OVER (ORDER BY start) AS place"
                f" FROM (SELECT MIN(k) AS start{tiles}) s"
            ).collect()
            return range_predicates(key, [row[0] for row in rows], [int(row[1]) for row in rows])
        return range_predicates(key, [row[0] for row in starts.collect()])

    def _page_ranges(self, name: str, parts: int | None) -> list[tuple[str, list[str]]]:
        """Page ranges of a table, or of each leaf of a partitioned one; none for a view."""
        table = "to_regclass('" + name.replace("'", "''") + "')"
        try:
            stored = self._query(
                "SELECT n.nspname::text AS schema_name, c.relname::text AS table_name,"
                " pg_relation_size(c.oid) AS bytes,"
                " current_setting('block_size')::bigint AS page_bytes"
                " FROM pg_class c JOIN pg_namespace n ON n.oid = c.relnamespace"
                f" WHERE (c.oid = {table} AND c.relkind IN ('r', 'm')) OR c.oid IN"
                f" (SELECT relid::oid FROM pg_partition_tree({table}) WHERE isleaf)"
            ).collect()
        except Exception as error:
            if not _LACKING.search(str(error)):
                raise
            log.warning("%s: no page ranges, read by one task: %s", name, error)
            stored = []
        total = sum(row.bytes for row in stored)
        if not total:
            return [(name, [])]
        wanted = parts or math.ceil(total / self.part_bytes)
        return [
            (
                f"{quote_name(row.schema_name)}.{quote_name(row.table_name)}",
                page_predicates(row.bytes // row.page_bytes, round(wanted * row.bytes / total)),
            )
            for row in stored
        ]
