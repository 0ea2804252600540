import pytest
from pyspark.sql import types as T

from tableferry.frames import small_frame
from tableferry.functions.types import (
    TYPE_MAP,
    SourceColumn,
    json_columns,
    map_type,
    source_type_of,
    spark_type,
    target_type_of,
    type_map_frame,
    with_target_types,
)


@pytest.mark.parametrize(
    "source, target",
    [
        ("integer", "INTEGER"),
        ("numeric", "NUMBER"),
        ("real", "FLOAT"),
        ("character varying", "TEXT"),
        ("inet", "TEXT"),
        ("bytea", "BINARY"),
        ("time with time zone", "TIME"),
        ("jsonb", "VARIANT"),
        ("interval", "TEXT"),
        ("ARRAY", "TEXT"),
        ("USER-DEFINED", "TEXT"),
        ("INTEGER", "TEXT"),  # names are matched as they are
    ],
)
def test_map_type(source, target):
    assert map_type(source) == target


def test_map_has_every_type(spark):
    assert len(TYPE_MAP) == 20
    assert type_map_frame(spark).count() == 20


def test_frame_and_function_agree(spark):
    names = [*TYPE_MAP, "interval", "geometry"]
    frame = with_target_types(small_frame(spark, [(n,) for n in names], "source_type string"))
    assert {r.source_type: r.target_type for r in frame.collect()} == {n: map_type(n) for n in names}


def test_json_columns(spark):
    catalog = small_frame(
        spark, [("a", "json"), ("b", "text"), ("c", "jsonb")], "column_name string, source_type string"
    )
    assert sorted(r.column_name for r in json_columns(catalog).collect()) == ["a", "c"]


def test_numeric_keeps_precision():
    assert spark_type("NUMBER", T.DecimalType(18, 4)) == T.DecimalType(18, 4)
    assert spark_type("NUMBER", T.StringType()) == T.DecimalType(38, 18)


def test_time_is_text_unless_asked():
    assert spark_type("TIME", T.StringType()) == T.StringType()
    assert spark_type("TIME", T.StringType(), "time") == T.TimeType(6)


@pytest.mark.parametrize("name", sorted(set(TYPE_MAP.values())))
def test_stored_type_reports_its_name(name):
    assert target_type_of(spark_type(name, T.DecimalType(10, 2), "time")) == name


def test_source_type_names_come_from_the_map():
    for data_type in (T.ShortType(), T.LongType(), T.DoubleType(), T.BinaryType(), T.VariantType()):
        assert source_type_of(data_type) in TYPE_MAP
    assert map_type(source_type_of(T.ArrayType(T.IntegerType()))) == "TEXT"
    assert SourceColumn("x", "json").is_json and not SourceColumn("x", "text").is_json
