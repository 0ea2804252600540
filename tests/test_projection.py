import json
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.projection import (
    ColumnNameError,
    ProjectionOptions,
    hex_text,
    hex_to_binary,
    project,
    quote_identifier,
)
from tableferry.functions.types import SourceColumn

STAMP = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)

# name, source type, delivered Spark type, values
ALL_TYPES = [
    ("c_int", "integer", "int", [None, -(2**31), 2**31 - 1]),
    ("c_big", "bigint", "bigint", [None, -(2**63), 2**63 - 1]),
    ("c_small", "smallint", "smallint", [None, -32768, 32767]),
    ("c_num", "numeric", "decimal(18,4)", [Decimal("0.0001"), Decimal("-99999999999999.9999"), None]),
    ("c_dbl", "double precision", "double", [float("inf"), -0.5, None]),
    ("c_real", "real", "float", [float("-inf"), 0.25, None]),
    ("c_bool", "boolean", "boolean", [True, False, None]),
    ("c_text", "text", "string", ["", "a'b\"c\nü ", None]),
    ("c_vc", "character varying", "string", ["x", "y", None]),
    ("c_ch", "character", "string", ["x  ", " ", None]),
    ("c_uuid", "uuid", "string", ["6f2c4a3e-0000-0000-0000-000000000001", None, None]),
    ("c_inet", "inet", "string", ["10.0.0.1", None, None]),
    ("c_bytes", "bytea", "binary", [b"", bytes.fromhex("00ff10"), None]),
    ("c_ts", "timestamp without time zone", "timestamp_ntz", [datetime(2024, 1, 2, 3, 4, 5, 678901), None, None]),
    ("c_tstz", "timestamp with time zone", "timestamp", [datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc), None, None]),
    ("c_date", "date", "date", [date(1970, 1, 1), date(2024, 2, 29), None]),
    ("c_time", "time without time zone", "string", ["12:34:56", None, None]),
    ("c_timetz", "time with time zone", "string", ["12:34:56", None, None]),
    ("c_json", "json", "string", ['{"b":[1,2.50],"a":{"x":null}}', "[1]", None]),
    ("c_jsonb", "jsonb", "string", ["null", '"text"', "12"]),
    ("c_arr", "ARRAY", "array<int>", [[], [1, 2], None]),
    ("c_interval", "interval", "interval day to second", [timedelta(days=1, hours=2), None, None]),
    ("c_struct", "USER-DEFINED", "struct<a:int>", [(1,), None, None]),
]
EXPECTED = {
    "C_INT": "int", "C_BIG": "bigint", "C_SMALL": "smallint", "C_NUM": "decimal(18,4)",
    "C_DBL": "double", "C_REAL": "double", "C_BOOL": "boolean", "C_TEXT": "string",
    "C_VC": "string", "C_CH": "string", "C_UUID": "string", "C_INET": "string",
    "C_BYTES": "binary", "C_TS": "timestamp_ntz", "C_TSTZ": "timestamp", "C_DATE": "date",
    "C_TIME": "string", "C_TIMETZ": "string", "C_JSON": "variant", "C_JSONB": "variant",
    "C_ARR": "string", "C_INTERVAL": "string", "C_STRUCT": "string", "LOADED_AT_UTC": "timestamp",
}


def all_types(spark):
    schema = ", ".join(f"{name} {delivered}" for name, _, delivered, _ in ALL_TYPES)
    rows = list(zip(*(values for *_, values in ALL_TYPES)))
    return spark.createDataFrame(rows, schema), [SourceColumn(n, t) for n, t, *_ in ALL_TYPES]


def one_column(spark, source_type, delivered, values, **options):
    df = spark.createDataFrame([(v,) for v in values], f"v {delivered}").coalesce(1)
    rows = project(df, [SourceColumn("v", source_type)], STAMP, ProjectionOptions(**options))
    return rows


def test_all_types(spark):
    df, columns = all_types(spark)
    out = project(df, columns, STAMP)
    assert {f.name: f.dataType.simpleString() for f in out.schema.fields} == EXPECTED
    text = [f.name for f in out.schema.fields if f.name not in ("C_JSON", "C_JSONB")]
    rows = out.select(*text, F.to_json("C_JSON").alias("C_JSON"), F.to_json("C_JSONB").alias("C_JSONB"))
    rows = sorted((r.asDict() for r in rows.collect()), key=lambda r: str(r["C_NUM"]))
    by_num = {r["C_NUM"]: r for r in rows}
    first, second, third = by_num[Decimal("0.0001")], by_num[Decimal("-99999999999999.9999")], by_num[None]
    assert json.loads(first["C_JSON"]) == {"a": {"x": None}, "b": [1, 2.5]}
    assert first["C_JSONB"] is None  # a JSON null document is SQL NULL
    assert (second["C_JSONB"], third["C_JSONB"]) == ('"text"', "12")
    assert bytes(first["C_BYTES"]) == b"" and bytes(second["C_BYTES"]) == b"\x00\xff\x10"
    assert first["C_DBL"] == float("inf") and first["C_REAL"] == float("-inf")
    assert second["C_TEXT"] == "a'b\"c\nü " and first["C_CH"] == "x  "
    assert first["C_TS"] == datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert (first["C_ARR"], second["C_ARR"], third["C_ARR"]) == ("[]", "[1,2]", None)
    assert first["C_INTERVAL"] == "INTERVAL '1 02:00:00' DAY TO SECOND"
    assert first["C_STRUCT"] == '{"a":1}'
    nulls = ("C_DBL", "C_REAL", "C_BOOL", "C_TEXT", "C_BYTES", "C_TS", "C_TSTZ", "C_DATE", "C_JSON")
    assert all(third[name] is None for name in nulls)
    assert third["C_INT"] == 2**31 - 1 and first["C_INT"] is None


def test_real_keeps_the_number_it_shows(spark):
    values = [0.1, 3.4028235e38, -1e-45, float("inf"), None]
    rows = one_column(spark, "real", "float", values)
    assert rows.schema["V"].dataType == T.DoubleType()
    assert [r.V for r in rows.collect()] == [0.1, 3.4028235e38, -1.4e-45, float("inf"), None]
    nan = one_column(spark, "real", "float", [float("nan")]).first().V
    assert nan != nan


def test_nan_survives(spark):
    row = one_column(spark, "double precision", "double", [float("nan")]).first()
    assert row.V != row.V


def test_stamp_is_one_instant_for_all_rows(spark):
    df, columns = all_types(spark)
    stamps = project(df, columns, STAMP).select(F.unix_micros("LOADED_AT_UTC")).distinct().collect()
    assert [r[0] for r in stamps] == [int(STAMP.timestamp() * 1_000_000)]


def test_stamp_needs_a_zone(spark):
    with pytest.raises(ValueError):
        project(spark.range(1), [SourceColumn("id", "bigint")], datetime(2024, 1, 1))


def test_projection_is_one_narrow_select(spark):
    df, columns = all_types(spark)
    plan = project(df, columns, STAMP)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_names_differing_by_case_are_refused(spark):
    columns = [SourceColumn("a", "text"), SourceColumn("A", "text")]
    with pytest.raises(ColumnNameError, match="differ only by case: A"):
        project(spark.range(1).selectExpr("'x' AS a"), columns, STAMP)


def test_stamp_column_in_source_is_refused(spark):
    columns = [SourceColumn("loaded_at_utc", "text")]
    with pytest.raises(ColumnNameError, match="LOADED_AT_UTC"):
        project(spark.range(1).selectExpr("'x' AS loaded_at_utc"), columns, STAMP)


def test_odd_column_names(spark):
    df = spark.range(1).selectExpr("1 AS `a.b`", "2 AS `c d`", "3 AS `e``f`")
    columns = [SourceColumn(n, "integer") for n in df.columns]
    assert project(df, columns, STAMP).columns == ["A.B", "C D", "E`F", "LOADED_AT_UTC"]
    assert quote_identifier("e`f") == "`e``f`"


@pytest.mark.parametrize("names", [["a"], ["a", "b", "c"], []])
def test_column_list_that_differs_from_the_data_is_refused(spark, names):
    columns = [SourceColumn(n, "integer") for n in names]
    with pytest.raises(ColumnNameError, match="listed"):
        project(spark.range(1).selectExpr("1 AS a", "2 AS b"), columns, STAMP)


def test_bad_json_fails_or_is_null(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        one_column(spark, "json", "string", ["{bad"]).collect()
    lenient = one_column(spark, "json", "string", ["{bad", "{}"], on_bad_json="null")
    assert [r.n for r in lenient.select(F.col("V").isNull().alias("n")).collect()] == [True, False]


def test_repeated_key_keeps_last_value_and_setting_is_restored(spark):
    key = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(key, None)
    rows = one_column(spark, "json", "string", ['{"a":1,"b":0,"a":2}'])
    assert spark.conf.get(key, None) == before
    assert rows.select(F.to_json("V")).first()[0] == '{"a":2,"b":0}'


def test_json_from_containers_and_variants(spark):
    maps = one_column(spark, "jsonb", "map<string,int>", [{"k": 1}])
    assert maps.select(F.to_json("V")).first()[0] == '{"k":1}'
    variant = spark.range(1).select(F.parse_json(F.lit('{"k":[1]}')).alias("v"))
    out = project(variant, [SourceColumn("v", "jsonb")], STAMP)
    assert out.schema["V"].dataType == T.VariantType()
    assert out.select(F.to_json("V")).first()[0] == '{"k":[1]}'


def test_hex_text_is_decoded(spark):
    rows = one_column(spark, "bytea", "string", ["00ff10", "", None])
    assert {None if r.V is None else bytes(r.V) for r in rows.collect()} == {b"\x00\xff\x10", b"", None}
    with pytest.raises(Exception, match="(?i)hex"):
        one_column(spark, "bytea", "string", ["zz"]).collect()
    assert one_column(spark, "bytea", "string", ["zz"], on_bad_hex="null").first().V is None


def test_hex_roundtrip_of_every_byte(spark):
    data = bytes(range(256))
    df = spark.createDataFrame([(data,), (None,)], "b binary")
    text = df.select(hex_text(F.col("b")).alias("t"))
    assert {r.t for r in text.collect()} == {data.hex(), None}
    back = text.select(hex_to_binary(F.col("t")).alias("b")).collect()
    assert {None if r.b is None else bytes(r.b) for r in back} == {data, None}


def test_time_of_day(spark):
    ts = one_column(spark, "time without time zone", "timestamp_ntz", [datetime(1970, 1, 1, 1, 2, 3, 40)])
    assert ts.first().V == "01:02:03.000040"
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        times = spark.sql("SELECT TIME'01:02:03.5' AS v UNION ALL SELECT TIME'01:02:03'")
        columns = [SourceColumn("v", "time without time zone")]
        text = project(times, columns, STAMP)
        assert sorted(r.V for r in text.collect()) == ["01:02:03.000000", "01:02:03.500000"]
        kept = project(times, columns, STAMP, ProjectionOptions(time_as="time"))
        assert kept.schema["V"].dataType == T.TimeType(6)
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


def test_options_are_checked():
    with pytest.raises(ValueError):
        ProjectionOptions(on_bad_json="ignore")
