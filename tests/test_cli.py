import pytest

from tableferry import JdbcSource
from tableferry.__main__ import parser, run, source_of


@pytest.fixture
def folder(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in" / "one.parquet"))
    spark.range(2).selectExpr("'{}' AS j").write.parquet(str(tmp_path / "in" / "two.parquet"))
    return str(tmp_path / "in")


def call(spark, *argv):
    return run(spark, parser().parse_args(argv))


def test_sync_reconcile_profile(spark, target, folder, capsys):
    where = ["--source-path", folder, "--target-schema", target.schema, "--json-column", "two.j"]
    assert call(spark, "sync", *where, "--workers", "2", "--exclude", "none", "--title", "Copy") == 0
    out = capsys.readouterr().out
    assert out.startswith("Copy: Sync Completed | ") and "`one` `two`" in out
    assert target.read("two").schema["J"].dataType.simpleString() == "variant"

    assert call(spark, "reconcile", *where) == 0
    assert f"TOTALS: PostgreSQL: {5:10} | Snowflake: {5:10}" in capsys.readouterr().out
    spark.sql(f"DROP TABLE {target.name('one')}")
    assert call(spark, "reconcile", *where) == 1
    assert "NOT FOUND" in capsys.readouterr().out

    assert call(spark, "profile", "--schema", target.schema) == 0
    assert f"✓ {target.schema}: 2 tables\n    etl_metadata: 2 rows\n    two: 2 rows" in capsys.readouterr().out


def test_failed_sync_is_reported_in_the_exit_code(spark, target, folder, capsys):
    spark.range(1).selectExpr("'{bad' AS j").write.mode("overwrite").parquet(folder + "/two.parquet")
    where = ["--source-path", folder, "--target-schema", target.schema, "--json-column", "two.j"]
    assert call(spark, "sync", *where) == 1
    assert "* Failures (1)*" in capsys.readouterr().out


def test_jdbc_arguments(spark, monkeypatch):
    monkeypatch.setenv("DB_USER", "u")
    monkeypatch.setenv("DB_PASSWORD", "p")
    argv = ["sync", "--jdbc-url", "jdbc:postgresql://h/d", "--jdbc-option", "sslmode=require"]
    argv += ["--batch-size", "77", "--split-column", "orders.o_id"]
    source = source_of(spark, parser().parse_args(argv))
    assert isinstance(source, JdbcSource) and source.fetch_size == 77
    assert source.splits["orders"].column == "o_id"
    assert source.properties == {"sslmode": "require", "user": "u", "password": "p"}
