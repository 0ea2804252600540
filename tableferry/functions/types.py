"""Source type names, target type names and the Spark types that hold them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.frames import small_frame

# Source type name -> target type name. A name that is not listed maps to TEXT.
TYPE_MAP = {
    "integer": "INTEGER",
    "bigint": "BIGINT",
    "smallint": "SMALLINT",
    "numeric": "NUMBER",
    "double precision": "FLOAT",
    "real": "FLOAT",
    "boolean": "BOOLEAN",
    "text": "TEXT",
    "character varying": "TEXT",
    "character": "TEXT",
    "uuid": "TEXT",
    "bytea": "BINARY",
    "timestamp without time zone": "TIMESTAMP_NTZ",
    "timestamp with time zone": "TIMESTAMP_TZ",
    "date": "DATE",
    "time without time zone": "TIME",
    "time with time zone": "TIME",
    "json": "VARIANT",
    "jsonb": "VARIANT",
    "inet": "TEXT",
}
DEFAULT_TARGET = "TEXT"
JSON_TYPES = ("json", "jsonb")

# Unbounded source numerics carry no precision of their own.
UNBOUNDED_NUMERIC = T.DecimalType(38, 18)

_SPARK_TYPES: dict[str, T.DataType] = {
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "SMALLINT": T.ShortType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TEXT": T.StringType(),
    "BINARY": T.BinaryType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "TIMESTAMP_TZ": T.TimestampType(),
    "DATE": T.DateType(),
    "VARIANT": T.VariantType(),
}


@dataclass(frozen=True)
class SourceColumn:
    """One row of the column catalog."""

    name: str
    source_type: str

    @property
    def target_type(self) -> str:
        return map_type(self.source_type)

    @property
    def is_json(self) -> bool:
        return self.source_type in JSON_TYPES


def map_type(source_type: str) -> str:
    """Target type name of a source type name; TEXT when it is not known."""
    return TYPE_MAP.get(source_type, DEFAULT_TARGET)


def spark_type(target_type: str, delivered: T.DataType, time_as: str = "text") -> T.DataType:
    """Spark type of a target type; numerics keep the precision and scale they arrive with."""
    if target_type == "NUMBER":
        return delivered if isinstance(delivered, T.DecimalType) else UNBOUNDED_NUMERIC
    if target_type == "TIME":
        return T.TimeType(6) if time_as == "time" else T.StringType()
    return _SPARK_TYPES[target_type]


def target_type_of(data_type: T.DataType) -> str:
    """Target type name under which the catalog reports a stored Spark type."""
    if isinstance(data_type, T.DecimalType):
        return "NUMBER"
    if isinstance(data_type, T.TimeType):
        return "TIME"
    for name, known in _SPARK_TYPES.items():
        if type(data_type) is type(known):
            return name
    return DEFAULT_TARGET


def source_type_of(data_type: T.DataType) -> str:
    """Source type name for a column known only by its Spark type (files, catalog tables)."""
    by_class = {
        T.ByteType: "smallint",
        T.ShortType: "smallint",
        T.IntegerType: "integer",
        T.LongType: "bigint",
        T.DecimalType: "numeric",
        T.FloatType: "real",
        T.DoubleType: "double precision",
        T.BooleanType: "boolean",
        T.StringType: "text",
        T.VarcharType: "character varying",
        T.CharType: "character",
        T.BinaryType: "bytea",
        T.TimestampNTZType: "timestamp without time zone",
        T.TimestampType: "timestamp with time zone",
        T.DateType: "date",
        T.TimeType: "time without time zone",
        T.VariantType: "jsonb",
        T.ArrayType: "ARRAY",
    }
    return by_class.get(type(data_type), data_type.simpleString())


def type_map_frame(spark: SparkSession) -> DataFrame:
    """The type map as a table ``(source_type, target_type)``."""
    return small_frame(spark, list(TYPE_MAP.items()), "source_type string, target_type string")


def with_target_types(columns: DataFrame, source_type: str = "source_type") -> DataFrame:
    """Add ``target_type`` to a column catalog: a left join with TEXT for what is not mapped."""
    mapping = F.broadcast(type_map_frame(columns.sparkSession))  # 20 fixed rows
    mapping = mapping.withColumnRenamed("source_type", "__mapped_type")
    joined = columns.join(mapping, columns[source_type] == F.col("__mapped_type"), "left")
    return joined.withColumn(
        "target_type", F.coalesce("target_type", F.lit(DEFAULT_TARGET))
    ).drop("__mapped_type")


def json_columns(columns: DataFrame) -> DataFrame:
    """Rows of a column catalog that hold JSON."""
    return columns.filter(is_json_type(F.col("source_type")))


def is_json_type(source_type: Column) -> Column:
    return source_type.isin(*JSON_TYPES)
