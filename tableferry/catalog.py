"""Names in a schema of the session catalog, listed without loading each table's entry."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tableferry.functions.projection import quote_identifier


def views(spark: SparkSession, schema: str) -> list[str]:
    """Views of a schema, sorted."""
    rows = spark.sql(f"SHOW VIEWS IN {quote_identifier(schema)}").collect()
    return sorted(row.viewName for row in rows if not row.isTemporary)


def base_tables(spark: SparkSession, schema: str, prefix: str = "") -> list[str]:
    """Tables of a schema that are not views, sorted; all of them or those with a prefix."""
    pattern = prefix.replace("\\", "").replace("'", "\\'")
    listed = spark.sql(f"SHOW TABLES IN {quote_identifier(schema)} LIKE '{pattern}*'").collect()
    names = {row.tableName for row in listed if not row.isTemporary}
    names = {name for name in names if name.startswith(prefix)}
    return sorted(names.difference(views(spark, schema))) if names else []
