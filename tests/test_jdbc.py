"""The database itself is not available here: what is sent to it is checked instead."""

import re
from decimal import Decimal
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from tableferry import JdbcSource, Split
from tableferry.operators.counts import source_counts
from tableferry.sources import introspect_columns, table_names
from tableferry.sources.jdbc import page_predicates, quote_name, range_predicates, sql_literal

URL = "jdbc:postgresql://db.example.org/shop"


def covered(predicates, pages):
    """How many predicates hold for each page."""
    hits = [0] * pages
    for predicate in predicates:
        low = re.search(r"ctid >= '\((\d+),0\)'", predicate)
        high = re.search(r"ctid < '\((\d+),0\)'", predicate)
        for page in range(int(low[1]) if low else 0, min(pages, int(high[1])) if high else pages):
            hits[page] += 1
    return hits


@pytest.mark.parametrize("pages, parts", [(2, 2), (10, 3), (1000, 7), (64, 64), (5, 50)])
def test_every_page_is_read_once(pages, parts):
    predicates = page_predicates(pages, parts)
    assert len(predicates) == min(parts, pages)
    # rows that appear on later pages fall in the open last range
    assert covered(predicates, pages + 10) == [1] * (pages + 10)


def test_small_tables_are_not_cut():
    assert page_predicates(0, 4) == page_predicates(1, 4) == page_predicates(100, 1) == []


def test_names_are_escaped(spark):
    assert quote_name('we"ird') == '"we""ird"'
    assert JdbcSource(spark, URL, schema="s").qualified("T x") == '"s"."T x"'


def test_options(spark):
    source = JdbcSource(spark, URL, properties={"user": "u", "password": "p"}, fetch_size=2000)
    assert source.options(dbtable="t") == {
        "url": URL, "fetchsize": "2000", "preferTimestampNTZ": "true",
        "user": "u", "password": "p", "dbtable": "t",
    }


class Catalog(JdbcSource):
    """Answers catalog queries from rows instead of a connection."""

    pages = [("public", "b", 10 << 30, 8192)]

    def _query(self, sql):
        if "information_schema.tables" in sql:
            rows = [("public", "b", "BASE TABLE"), ("public", "a", "VIEW"), ("other", "c", "BASE TABLE")]
            return self.spark.createDataFrame(rows, "table_schema string, table_name string, table_type string")
        if "information_schema.columns" in sql:
            rows = [("public", "b", 2, "j", "jsonb"), ("public", "b", 1, "id", "bigint"), ("other", "c", 1, "x", "text")]
            return self.spark.createDataFrame(
                rows, "table_schema string, table_name string, ordinal_position int, column_name string, data_type string"
            )
        if "pg_class" in sql:
            return self.spark.createDataFrame(
                self.pages, "schema_name string, table_name string, bytes bigint, page_bytes bigint"
            )
        if "COUNT(*)" in sql:
            self.counted = sql
            return self.spark.createDataFrame([(Decimal(7),)], "ROW_COUNT decimal(20,0)")
        return self.spark.createDataFrame([(9,), (1,), (9,), (5,)], "start int")


def test_discovery(spark):
    source = Catalog(spark, URL)
    assert table_names(source) == ["a", "b"]
    assert table_names(source, exclude=["a"]) == ["b"]
    assert table_names(source, base_tables_only=True) == ["b"]


def test_columns_in_ordinal_order(spark):
    source = Catalog(spark, URL)
    assert [(c.name, c.target_type) for c in source.columns("b")] == [("id", "BIGINT"), ("j", "VARIANT")]
    assert source.columns("c") == [] and set(introspect_columns(source, [])) == {"b"}


def ranges(source, parts=None):
    return {name: len(predicates) for name, predicates in source._page_ranges(source.qualified("b"), parts)}


def test_page_ranges_follow_the_size(spark):
    source = Catalog(spark, URL, max_connections=100)
    assert ranges(source) == {'"public"."b"': 40}  # 10 GiB in runs of 256 MiB
    assert ranges(source, 7) == {'"public"."b"': 7}
    assert ranges(Catalog(spark, URL)) == {'"public"."b"': 40}  # connections do not bound pieces
    source.pages = [("public", "b", 0, 8192)]
    assert ranges(source) == {'"public"."b"': 0}
    source.pages = []
    assert ranges(source) == {'"public"."b"': 0}


def test_partitions_are_cut_by_their_size(spark):
    source = Catalog(spark, URL, max_connections=100)
    source.pages = [("public", "b_1", 9 << 30, 8192), ("p", 'b"2', 1 << 30, 8192), ("p", "b_3", 0, 8192)]
    assert ranges(source) == {'"public"."b_1"': 36, '"p"."b""2"': 4, '"p"."b_3"': 0}


def test_database_without_page_ranges_is_read_by_one_task(spark):
    class Older(Catalog):
        def _query(self, sql):
            raise RuntimeError("function pg_partition_tree does not exist")

    assert ranges(Older(spark, URL)) == {'"public"."b"': 0}


@pytest.fixture
def skewed(spark, target):
    """A table of which a third has one key and the rest bunches up, behind standard SQL."""
    settings = {"spark.sql.ansi.enabled": "true", "spark.sql.ansi.doubleQuotedIdentifiers": "true"}
    before = {key: spark.conf.get(key, None) for key in settings}
    rows = spark.range(9000).selectExpr(
        "id",
        "CASE WHEN id < 3000 THEN 77 WHEN id < 8900 THEN 1000000 + id WHEN id < 8990 THEN id * id END AS key",
        "DATE'2024-01-01' + CAST(id % 50 AS INT) AS day",
        "TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS moment",
        "concat('o', chr(39), id % 1000) AS word",
    )
    rows.write.saveAsTable(target.name("b"))
    for key, value in settings.items():
        spark.conf.set(key, value)

    class Standard(JdbcSource):
        def _query(self, sql):
            return self.spark.sql(sql)

    yield Standard(spark, "jdbc:other:x", schema=target.schema), target.read("b")
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("column", ["id", "key", "day", "moment", "word"])
def test_key_ranges_cover_the_table_evenly(skewed, column):
    source, rows = skewed
    predicates = source._key_ranges(source.qualified("b"), Split(parts=9, column=column))
    sizes = [rows.filter(p).count() for p in predicates]
    hits = reduce(add, (F.coalesce(F.expr(f"({p})"), F.lit(False)).cast("int") for p in predicates))
    assert rows.filter(hits != 1).count() == 0
    assert sum(sizes) == 9000 and predicates[-1].endswith(f' OR "{column}" IS NULL')
    # 1000 rows each; only the hot key, alone in its range, is larger.
    others = [size for size in sizes if not (column == "key" and size == 3000)]
    assert max(others) <= 1200, sizes


def test_few_keys_make_few_ranges():
    assert range_predicates("k", []) == []
    assert range_predicates("k", [5]) == ["k >= 5", "k < 5 OR k IS NULL"]
    assert range_predicates("k", [7, 5, 5]) == ["k = 5", "k > 5 AND k < 7", "k >= 7", "k < 5 OR k IS NULL"]
    assert sql_literal("it's") == "'it''s'" and sql_literal(Decimal("1.50")) == "1.50"


def test_listing_filter_is_a_plain_column_predicate(spark):
    plan = Catalog(spark, URL).listing()._jdf.queryExecution().optimizedPlan().toString()
    assert "table_schema" in plan and "public" in plan


def test_the_database_counts(spark):
    source = Catalog(spark, URL)
    assert [tuple(r) for r in source_counts(source, ["b"]).collect()] == [("b", 7)]
    assert source.counted == 'SELECT COUNT(*) AS row_count FROM "public"."b"'


class Recorded(Catalog):
    """Keeps what would be read, and reads rows with the columns in another order."""

    def __init__(self, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.pieces = []

    def _read_piece(self, name, predicates):
        self.pieces.append((name, predicates))
        rows = self.spark.range(len(self.pieces)).selectExpr("'{}' AS j", "id")
        return rows.repartition(max(1, len(predicates)))


def pieces(source):
    frame = source.read("b")
    return source.pieces, frame


def test_way_of_reading(spark):
    name = '"public"."b"'
    given = ["x < 1", "x >= 1"]
    assert pieces(Recorded(spark, URL, splits={"b": Split(predicates=given)}))[0] == [(name, given)]
    by_key, _ = pieces(Recorded(spark, URL, splits={"b": Split(column="id")}))
    assert by_key == [
        (
            name,
            [
                '"id" >= 1 AND "id" < 5',
                '"id" >= 5 AND "id" < 9',
                '"id" = 9',
                '"id" > 9',
                '"id" < 1 OR "id" IS NULL',
            ],
        )
    ]
    by_pages, frame = pieces(Recorded(spark, URL))
    assert by_pages[0][0] == name and len(by_pages[0][1]) == 40
    assert frame.rdd.getNumPartitions() == 32
    assert pieces(Recorded(spark, "jdbc:other:x"))[0] == [(name, [])]


def test_partitions_are_read_as_one_table(spark):
    source = Recorded(spark, URL, max_connections=5)
    source.pages = [("public", f"b_{i}", 1 << 30, 8192) for i in range(4)]
    read, frame = pieces(source)
    assert [name for name, _ in read] == [f'"public"."b_{i}"' for i in range(4)]
    assert frame.columns == ["id", "j"] and frame.count() == 1 + 2 + 3 + 4


def test_connections_are_bounded(spark):
    source = Recorded(spark, URL, max_connections=3, splits={"b": Split(predicates=[f"x = {i}" for i in range(50)])})
    _, frame = pieces(source)
    assert frame.rdd.getNumPartitions() == 3


def test_a_load_takes_the_pieces_in_waves(spark):
    source = Recorded(spark, URL, max_connections=16)
    waves = source.waves("b")
    assert len(waves) == 3 and source.pieces == []  # opened when their turn comes
    for wave in waves:
        wave()
    sizes = [len(predicates) for _, predicates in source.pieces]
    assert sizes == [16, 16, 8] and {name for name, _ in source.pieces} == {'"public"."b"'}
    assert covered([p for _, predicates in source.pieces for p in predicates], 2000) == [1] * 2000


def test_waves_go_on_over_partitions(spark):
    source = Recorded(spark, URL, max_connections=6)
    source.pages = [("public", f"b_{i}", size << 20, 8192) for i, size in enumerate([1024, 100, 0, 768])]
    frames = [wave() for wave in source.waves("b")]
    # 4, 1 (whole), 1 (empty), 3 pieces: six connections, then the rest
    assert [name[-2] for name, _ in source.pieces] == list("0123") and len(frames) == 2
    assert [len(p) for _, p in source.pieces] == [4, 0, 0, 3]
    assert all(frame.columns == ["id", "j"] for frame in frames)


def test_keys_are_cut_by_the_number_of_rows(spark):
    class Asked(Catalog):
        def _query(self, sql):
            self.asked = [*getattr(self, "asked", []), sql]
            return super()._query(sql)

    source = Asked(spark, "jdbc:other:x", part_rows=2, max_connections=3)
    source._key_ranges('"public"."b"', Split(column="id"))
    assert "NTILE(4)" in source.asked[-1]  # 7 rows by 2


def test_errors_about_a_table_are_not_taken_for_an_old_database(spark):
    class Broken(Catalog):
        def _query(self, sql):
            raise RuntimeError('relation "public.b" does not exist')

    with pytest.raises(RuntimeError):
        ranges(Broken(spark, URL))


class Connection:
    """A DB-API connection that records what it is asked."""

    def __init__(self, log):
        self.log = log

    def cursor(self):
        return self

    def execute(self, sql):
        self.log.append(sql)

    def fetchone(self):
        return ("00000003-1B-1",)

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_all_reads_of_a_load_see_one_snapshot(spark):
    log = []
    source = Catalog(spark, URL, connect=lambda: Connection(log))
    assert "sessionInitStatement" not in source.options()
    with pytest.raises(ValueError), source.snapshot("b"):
        assert log[0].startswith("SET TRANSACTION ISOLATION LEVEL REPEATABLE READ")
        assert log[1:] == ["SELECT pg_export_snapshot()"]
        first = source.options()["sessionInitStatement"]
        assert first.endswith("SET TRANSACTION SNAPSHOT '00000003-1B-1'")
        more = source.options(sessionInitStatement="SET x = 1")["sessionInitStatement"]
        assert more == f"{first}; SET x = 1"
        raise ValueError
    assert log[2:] == ["rollback", "close", "close"]
    assert "sessionInitStatement" not in source.options()
    with Catalog(spark, URL).snapshot("b"):
        assert "sessionInitStatement" not in source.options()
