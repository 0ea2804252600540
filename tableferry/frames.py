"""Small driver-side rows (names, results, audit records) as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_frame(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """Metadata rows as a local relation; reading it back needs no job.

    Only for rows whose number follows the catalog (tables, columns, runs), never for table data.
    """
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = struct.fieldNames()
    records = [row if isinstance(row, dict) else dict(zip(names, row)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(struct))
    return spark.createDataFrame(table, schema=struct)
