"""What the schemas of the target catalog hold."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableferry.catalog import base_tables
from tableferry.frames import small_frame
from tableferry.operators.counts import collect_counts
from tableferry.operators.target import Target
from tableferry.operators.validate import stored_row_count
from tableferry.sources.base import count_rows

log = logging.getLogger(__name__)

# Fixed value: tables listed per schema.
LISTED = 10

NAMES_SCHEMA = "schema_name string, table_name string"
COUNTS_SCHEMA = "schema_name string, table_name string, row_count bigint"


def list_schemas(spark: SparkSession) -> DataFrame:
    """``(catalog, schema_name)`` of the current catalog."""
    rows = [(db.catalog, db.name) for db in spark.catalog.listDatabases()]
    return small_frame(spark, rows, "catalog string, schema_name string")


def list_base_tables(spark: SparkSession, schemas: Sequence[str]) -> DataFrame:
    """``(schema_name, table_name)``; a schema that cannot be listed is left out with a warning."""
    rows = []
    for schema in schemas:
        try:
            rows += [(schema, table) for table in base_tables(spark, schema)]
        except Exception as error:
            log.warning("cannot list %s: %s", schema, error)
    return small_frame(spark, rows, NAMES_SCHEMA)


def tables_per_schema(tables: DataFrame) -> DataFrame:
    """``(schema_name, n_tables)`` of the schemas that hold at least one table."""
    counted = tables.groupBy("schema_name").agg(F.count("table_name").alias("n_tables"))
    return counted.filter(F.col("n_tables") > 0)


def first_tables(tables: DataFrame, listed: int = LISTED) -> DataFrame:
    """The first tables of each schema by name, with how many there are and how many more."""
    by_name = Window.partitionBy("schema_name").orderBy("table_name")
    whole = Window.partitionBy("schema_name")
    ranked = tables.select(
        "schema_name",
        F.count(F.lit(1)).over(whole).alias("n_tables"),
        "table_name",
        F.row_number().over(by_name).alias("rn"),
    )
    n_more = F.greatest(F.col("n_tables") - listed, F.lit(0).cast("bigint"))
    return ranked.filter(F.col("rn") <= listed).withColumn("n_more", n_more)


def row_counts(spark: SparkSession, tables: Sequence[tuple[str, str]]) -> DataFrame:
    """Row counts as the catalog knows them; only tables without statistics are counted."""
    known: dict[tuple[str, str], int | None] = {}
    unknown: dict[str, tuple[str, str]] = {}
    for schema, table in tables:
        target = Target(spark, schema)
        try:
            count = stored_row_count(target, table)
            if count is None:
                unknown[target.name(table)] = (schema, table)
            known[schema, table] = count
        except Exception as error:
            log.warning("cannot describe %s.%s: %s", schema, table, error)
            known[schema, table] = None
    counted = collect_counts(spark, {name: count_rows(spark.table(name)) for name in unknown})
    known |= {unknown[name]: count for name, count in counted.items()}
    return small_frame(spark, [(*key, count) for key, count in known.items()], COUNTS_SCHEMA)


def catalog_profile(
    spark: SparkSession, schemas: Sequence[str] | None = None, listed: int = LISTED
) -> DataFrame:
    """``(schema_name, n_tables, table_name, rn, n_more, row_count)`` for the listed tables."""
    if schemas is None:
        schemas = [row.schema_name for row in list_schemas(spark).collect()]
    shown = first_tables(list_base_tables(spark, schemas), listed)
    names = [(row.schema_name, row.table_name) for row in shown.collect()]
    counts = row_counts(spark, names)
    return shown.join(counts, ["schema_name", "table_name"], "left").select(
        "schema_name", "n_tables", "table_name", "rn", "n_more", "row_count"
    )


def profile_lines(profile: DataFrame) -> DataFrame:
    """``(schema_name, position, line)``: heading, listed tables, and how many more."""
    heading = profile.filter(F.col("rn") == 1).select(
        "schema_name",
        F.lit(0).alias("position"),
        F.format_string("✓ %s: %d tables", "schema_name", "n_tables").alias("line"),
    )
    tables = profile.select(
        "schema_name",
        F.col("rn").alias("position"),
        F.format_string("    %s: %s rows", "table_name", F.col("row_count").cast("string")).alias("line"),
    )
    listed = profile.groupBy("schema_name").agg(
        F.max("rn").alias("last"), F.first("n_more").alias("n_more")
    )
    overflow = listed.filter(F.col("n_more") > 0).select(
        "schema_name",
        (F.col("last") + 1).alias("position"),
        F.format_string("    ... and %d more tables", "n_more").alias("line"),
    )
    return heading.unionAll(tables).unionAll(overflow).orderBy("schema_name", "position")
