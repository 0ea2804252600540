"""Run every registered query and its SQL side by side; also usable as a script."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from __spark_entry__ import oracle_sql, queries  # noqa: E402


SQL_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in sorted(os.listdir(sf_dir)):
        table, extension = os.path.splitext(name)
        if extension == ".parquet":
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{name}')"
            )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def rows_by_name(names, rows):
    """Column names in order of name, and the rows as a multiset."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """``None`` if both sides agree, otherwise what differs."""
    frame = queries()[name](spark, sf_dir)
    spark_names, spark_rows = rows_by_name(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(oracle_sql()[name])
    sql_names, sql_rows = rows_by_name([c[0] for c in cursor.description], cursor.fetchall())
    if spark_names != sql_names:
        return f"columns {spark_names} != {sql_names}"
    spark_types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    sql_types = {c[0]: SQL_TYPES.get(str(c[1]), str(c[1])) for c in cursor.description}
    if spark_types != sql_types:
        return f"types {sorted(set(spark_types.items()) ^ set(sql_types.items()))}"
    if spark_rows != sql_rows:
        extra = list((spark_rows - sql_rows).items())[:3]
        missing = list((sql_rows - spark_rows).items())[:3]
        return f"{sum(spark_rows.values())} rows against {sum(sql_rows.values())}; only Spark {extra}; only SQL {missing}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from tableferry import build_session

    spark = build_session(
        "check", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(sf_dir)
    failures = 0
    for name in names or queries():
        start = time.time()
        problem = compare(spark, connection, name, sf_dir)
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}"[:1500], flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
