"""What changed between two versions of a table, by key and row hash, and applying it.

Rows are told apart by their hash, so what is shuffled for all rows is 16 bytes each, added up where
the rows are: any number of copies of a row, or of rows with one key, is one row per task. Only hashes
that one version holds more often than the other lead back to rows and keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.functions.projection import quote_identifier
from tableferry.functions.rowhash import row_hash
from tableferry.functions.types import SourceColumn

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def digest(df: DataFrame, columns: Sequence[SourceColumn] | None = None) -> Column:
    """The row hash as 16 bytes."""
    return F.unhex(row_hash(df, columns))


def change_sets(
    old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[SourceColumn] | None = None
) -> DataFrame:
    """``op, copies, before, digest, row``: what turns the old version into the new one.

    A key under which exactly one row went and one came is an ``update``: ``before`` is the digest of the
    row that went. All else is ``insert`` or ``delete`` of so many ``copies``: under a key that repeats, or
    that is null in a column, rows have only their content to be known by. ``row`` is a struct of all columns,
    the new row of an insert or update and the old one of a delete.
    """
    if old.columns != new.columns:
        raise ValueError(f"versions with different columns: {old.columns} and {new.columns}")

    def side(frame: DataFrame, sign: int) -> DataFrame:
        whole = F.struct(*(F.col(quote_identifier(name)) for name in frame.columns))
        return frame.select(digest(frame, columns).alias("digest"), whole.alias("row"), F.lit(sign).alias("sign"))

    both = side(old, -1).unionAll(side(new, 1))
    deltas = both.groupBy("digest").agg(F.sum("sign").alias("delta")).where("delta <> 0")
    changed = (
        both.join(deltas, "digest")
        .groupBy("digest")
        .agg(F.first("delta").alias("delta"), F.first("row").alias("row"))
    )
    named = [F.col("row")[name].alias(f"k{place}") for place, name in enumerate(key)]
    names = [f"k{place}" for place in range(len(key))]
    whole_key = " AND ".join(f"{name} IS NOT NULL" for name in names)
    keyed = changed.select("*", *named)
    pairs = (
        keyed.where(whole_key)
        .groupBy(*names)
        .agg(
            F.sum(F.greatest("delta", F.lit(0))).alias("came"),
            F.sum(F.greatest(-F.col("delta"), F.lit(0))).alias("went"),
            F.max(F.when(F.col("delta") < 0, F.col("digest"))).alias("before"),
        )
        .where("came = 1 AND went = 1")
        .select(*names, "before")
    )
    # Keys that are not whole have no pair; joined, they would all meet in one task.
    single = keyed.where(f"NOT ({whole_key})").withColumn("before", F.lit(None).cast("binary"))
    paired = keyed.where(whole_key).join(pairs, names, "left")
    op = (
        F.when(F.col("before").isNotNull(), UPDATE).when(F.col("delta") > 0, INSERT).otherwise(DELETE)
    )
    return (
        paired.unionByName(single)
        .where("before IS NULL OR delta > 0")
        .select(op.alias("op"), F.abs("delta").alias("copies"), "before", "digest", "row")
    )


def apply_changes(
    old: DataFrame, changes: DataFrame, columns: Sequence[SourceColumn] | None = None
) -> DataFrame:
    """The new version: the old one without what went, and with what came."""
    whole = F.struct(*(F.col(quote_identifier(name)) for name in old.columns))
    rows = old.select(digest(old, columns).alias("digest"), whole.alias("row"))
    went = (
        changes.where(F.col("op").isin(UPDATE, DELETE))
        .select(F.coalesce("before", "digest").alias("digest"), F.col("copies").alias("went"))
        .groupBy("digest")
        .agg(F.sum("went").alias("went"))
    )
    # Of rows that went, as many copies stay as there are more of them.
    fewer = (
        rows.join(went, "digest")
        .groupBy("digest")
        .agg(F.first("row").alias("row"), (F.count(F.lit(1)) - F.first("went")).alias("copies"))
    )
    came = changes.where(F.col("op").isin(INSERT, UPDATE)).select("row", "copies")
    more = fewer.select("row", "copies").unionByName(came).where("copies > 0")
    repeated = more.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))))
    stay = rows.join(went, "digest", "left_anti").select("row")
    return stay.unionByName(repeated.select("row")).select("row.*")
