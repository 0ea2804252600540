"""Column projections that turn a source table into its target shape."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.types import SourceColumn, spark_type
from tableferry.session import scoped_conf

LOAD_STAMP = "LOADED_AT_UTC"


class ColumnNameError(ValueError):
    """Two target columns would get the same name."""


@dataclass(frozen=True)
class ProjectionOptions:
    """How values are converted.

    ``on_bad_json`` / ``on_bad_hex``: ``fail`` the table, or store ``null`` for the value.
    ``json_as``: ``variant``, or ``text`` to keep the JSON text (type validation then fails).
    ``time_as``: ``text`` (``HH:mm:ss.SSSSSS``) or ``time`` (needs ``spark.sql.timeType.enabled``).
    """

    on_bad_json: str = "fail"
    on_bad_hex: str = "fail"
    json_as: str = "variant"
    time_as: str = "text"

    def __post_init__(self):
        allowed = {
            "on_bad_json": ("fail", "null"),
            "on_bad_hex": ("fail", "null"),
            "json_as": ("variant", "text"),
            "time_as": ("text", "time"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}, got {getattr(self, name)!r}")


def quote_identifier(name: str) -> str:
    """Backtick-quoted identifier with embedded backticks escaped."""
    return "`" + name.replace("`", "``") + "`"


def target_names(columns: Sequence[SourceColumn]) -> list[str]:
    """Upper-cased target column names; a clash is an error before anything is written."""
    names = [column.name.upper() for column in columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ColumnNameError(f"columns differ only by case: {', '.join(clashes)}")
    if LOAD_STAMP in names:
        raise ColumnNameError(f"source already has a column named {LOAD_STAMP}")
    return names


def json_text(value: Column, data_type: T.DataType) -> Column:
    """JSON text of a column: text stays as it is, containers and variants are rendered."""
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def json_to_variant(text: Column, on_bad_json: str = "fail") -> Column:
    """Parse JSON text. A JSON ``null`` document becomes SQL NULL, as decoding it does."""
    parse = F.parse_json if on_bad_json == "fail" else F.try_parse_json
    is_null = F.btrim(text, F.lit(" \t\r\n")) == F.lit("null")
    return F.when(~is_null, parse(text))


def hex_text(value: Column) -> Column:
    """Binary as lower-case hex text."""
    return F.lower(F.hex(value))


def hex_to_binary(text: Column, on_bad_hex: str = "fail") -> Column:
    """Hex text as binary; malformed text fails, or becomes NULL."""
    decode = F.to_binary if on_bad_hex == "fail" else F.try_to_binary
    return decode(text, F.lit("hex"))


def time_text(value: Column, data_type: T.DataType) -> Column:
    """Time of day as ``HH:mm:ss.SSSSSS`` text."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "HH:mm:ss.SSSSSS")
    if isinstance(data_type, T.TimeType):
        text = value.cast("string")
        with_point = F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".")))
        return F.rpad(with_point, 15, "0")
    return value.cast("string")


def target_value(
    column: SourceColumn, field: T.StructField, options: ProjectionOptions
) -> Column:
    """Value of one source column in its target type."""
    value = F.col(quote_identifier(field.name))
    delivered = field.dataType
    target = column.target_type
    if target == "VARIANT":
        if options.json_as == "text":
            return json_text(value, delivered)
        if isinstance(delivered, T.VariantType):
            return F.when(~F.is_variant_null(value), value)
        return json_to_variant(json_text(value, delivered), options.on_bad_json)
    if target == "BINARY" and isinstance(delivered, T.StringType):
        return hex_to_binary(value, options.on_bad_hex)
    if target == "TIME" and options.time_as == "text":
        return time_text(value, delivered)
    if target == "TEXT":
        return json_text(value, delivered)
    if target == "FLOAT" and isinstance(delivered, T.FloatType):
        # A real shown as 0.1 stays 0.1; widening its bits would give 0.10000000149011612.
        return value.cast("string").cast("double")
    wanted = spark_type(target, delivered, options.time_as)
    return value if wanted == delivered else value.cast(wanted)


def project(
    df: DataFrame,
    columns: Sequence[SourceColumn],
    loaded_at: datetime,
    options: ProjectionOptions = ProjectionOptions(),
) -> DataFrame:
    """Target rows of a source table: one narrow select, load stamp last.

    The column list has to name exactly what is read, so that no column is lost unseen.
    """
    if loaded_at.tzinfo is None:
        raise ValueError("loaded_at needs a time zone")
    names = target_names(columns)
    fields = {field.name: field for field in df.schema.fields}
    listed = {column.name for column in columns}
    if not listed or listed != set(fields):
        missing, unlisted = sorted(listed - set(fields)), sorted(set(fields) - listed)
        raise ColumnNameError(
            f"columns listed but not read: {missing}; read but not listed: {unlisted}"
            if listed
            else "no columns listed"
        )
    values = [
        target_value(column, fields[column.name], options).alias(name)
        for column, name in zip(columns, names)
    ]
    stamp = F.lit(loaded_at).cast("timestamp").alias(LOAD_STAMP)
    # A repeated object key keeps its last value. Spark fixes that choice when the expression is
    # analysed, so the setting is held for that moment only.
    with scoped_conf(df.sparkSession, {"spark.sql.variant.allowDuplicateKeys": "true"}):
        projected = df.select(*values, stamp)
        projected.schema  # analysed here
    return projected
