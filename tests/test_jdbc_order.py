"""Ranges of a text key in the database's order, errors of the catalog query, tries of a write."""

from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from tableferry import JdbcSource, Split, SyncOptions
from tableferry.operators import stage
from tableferry.sources.jdbc import range_predicates
from tests.test_jdbc import URL, Catalog


@pytest.mark.parametrize("parts", [2, 7, 30])
def test_text_ranges_follow_a_case_insensitive_collation(spark, target, parts):
    words = "CASE WHEN id < 60 THEN 'mM' WHEN id < 90 THEN 'Mm' ELSE concat(char({} + id % 26), id) END"
    rows = spark.range(300).selectExpr(
        f"CAST(CASE WHEN id % 2 = 0 THEN {words.format(65)} ELSE {words.format(97)} END"
        " AS STRING COLLATE UTF8_LCASE) AS word"
    )
    rows.write.saveAsTable(target.name("b"))

    class Standard(JdbcSource):
        def _query(self, sql):
            return self.spark.sql(sql.replace('"', "`"))

    source, table = Standard(spark, "jdbc:other:x", schema=target.schema), target.read("b")
    predicates = source._key_ranges(source.qualified("b"), Split(parts=parts, column="word"))
    predicates = [p.replace('"', "`") for p in predicates]
    hits = reduce(add, (F.coalesce(F.expr(f"({p})"), F.lit(False)).cast("int") for p in predicates))
    assert len(predicates) > 2 and table.filter(hits != 1).count() == 0


def test_spellings_of_one_key_share_a_range():
    found = range_predicates("k", ["b", "A", "a", "B"], [2, 1, 1, 2])
    assert found == ["k = 'a'", "k > 'a' AND k < 'B'", "k = 'B'", "k > 'B'", "k < 'a' OR k IS NULL"]


def test_an_error_of_the_connection_does_not_change_the_way_of_reading(spark):
    class Refusing(Catalog):
        def _query(self, sql):
            raise RuntimeError("FATAL: password authentication failed")

    with pytest.raises(RuntimeError, match="password"):
        Refusing(spark, URL)._page_ranges('"public"."b"', None)


def test_each_asked_for_try_is_made(monkeypatch):
    tries = []

    def fail(*_):
        tries.append(1)
        raise RuntimeError("lost")

    monkeypatch.setattr(stage, "write_staging", fail)
    monkeypatch.setattr(stage.time, "sleep", lambda _: None)
    with pytest.raises(RuntimeError):
        stage.load_staging(None, None, "t", stage.waits_of(SyncOptions(write_attempts=6).write_attempts))
    assert len(tries) == 6 and stage.waits_of(1) == ()
    with pytest.raises(ValueError):
        SyncOptions(write_attempts=0)
