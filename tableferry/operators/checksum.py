"""Checksums of tables, and a tree of them that narrows a difference down to its rows.

A checksum is the number of rows and the sums of both halves of their hashes. Order does not matter,
repeated rows do, and every task adds up its own rows, so one row per task is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.rowhash import row_hash
from tableferry.functions.types import SourceColumn
from tableferry.sources.base import Source

#: Buckets of a fingerprint, and children of a node of its tree.
BUCKETS, FANOUT = 256, 16
PARTS = ("row_count", "sum_high", "sum_low")


def sums_of(hashes: str | Column) -> list[Column]:
    """Aggregates over row hashes (hex): their number and the sums of both halves."""
    value = F.col(hashes) if isinstance(hashes, str) else hashes

    def half(start: int) -> Column:
        # Unsigned; 38 digits hold the sum of any number of rows.
        number = F.conv(F.substring(value, start, 16), 16, 10).cast("decimal(38,0)")
        return F.coalesce(F.sum(number), F.lit(0).cast("decimal(38,0)"))

    return [F.count(value).alias("row_count"), half(1).alias("sum_high"), half(17).alias("sum_low")]


def checksum_text() -> Column:
    return F.concat_ws(":", *(F.col(part).cast("string") for part in PARTS))


def table_checksum(df: DataFrame, columns: Sequence[SourceColumn] | None = None) -> DataFrame:
    """One row, ``row_count, checksum``; equal for two tables with the same rows, whatever their order."""
    summed = df.select(row_hash(df, columns).alias("hash")).agg(*sums_of("hash"))
    return summed.select("row_count", checksum_text().alias("checksum"))


def checksums(source: Source, tables: Iterable[str]) -> DataFrame:
    """``table_name, row_count, checksum`` of each table."""
    parts = [
        table_checksum(source.read(table), source.columns(table)).select(
            F.lit(table).alias("table_name"), "row_count", "checksum"
        )
        for table in tables
    ]
    return reduce(DataFrame.unionAll, parts)


class Fingerprint:
    """Keys and row hashes of a version of a table, kept in a folder: one partition for each bucket of
    the key's hash, and beside them the sums of each bucket, which are the leaves of the tree."""

    def __init__(self, spark: SparkSession, folder: str, key: Sequence[str], buckets: int = BUCKETS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.key = list(key)
        self.buckets = buckets

    def write(
        self, rows: DataFrame, columns: Sequence[SourceColumn] | None = None, files: int = 1
    ) -> Fingerprint:
        """Take the fingerprint of a table; a bucket is spread over so many ``files``.

        Rows whose key is null in a column are dealt by their content, so they do not meet in one bucket.
        """
        whole = reduce(Column.__and__, (F.col(name).isNotNull() for name in self.key))
        spread = F.when(whole, F.xxhash64(*self.key)).otherwise(F.xxhash64("row_hash"))
        hashed = rows.select(*self.key, row_hash(rows, columns).alias("row_hash")).withColumn(
            "bucket", F.pmod(spread, F.lit(self.buckets)).cast("int")
        )
        # Within a bucket by content: a key with a third of all rows is in one bucket, not in one task.
        dealt = hashed.repartition("bucket", F.pmod(F.xxhash64("row_hash"), F.lit(files)))
        dealt.write.partitionBy("bucket").parquet(f"{self.folder}/rows")
        summed = self.rows.groupBy("bucket").agg(*sums_of("row_hash"))
        summed.coalesce(1).write.parquet(f"{self.folder}/sums")
        return self

    @property
    def rows(self) -> DataFrame:
        """``<key>, row_hash, bucket``, stored by bucket."""
        return self.spark.read.parquet(f"{self.folder}/rows")

    def nodes(self, level: int) -> DataFrame:
        """``node, row_count, sum_high, sum_low``: sums of ``FANOUT ** level`` buckets each."""
        sums = self.spark.read.parquet(f"{self.folder}/sums")
        node = F.floor(F.col("bucket") / FANOUT**level).cast("int")
        return sums.groupBy(node.alias("node")).agg(
            *(F.sum(part).cast("decimal(38,0)").alias(part) for part in PARTS)
        )


def differing_nodes(old: Fingerprint, new: Fingerprint, level: int, within: Sequence[int] | None = None) -> list[int]:
    """Nodes of a level whose sums differ, or that one side lacks; only ``within`` some nodes above, if given."""
    sides = []
    for side in (old, new):
        nodes = side.nodes(level)
        if within is not None:
            nodes = nodes.where(F.floor(F.col("node") / FANOUT).cast("int").isin(list(within)))
        sides.append(nodes.select("node", F.struct(*PARTS).alias("sums")))
    a, b = sides[0].alias("a"), sides[1].alias("b")
    joined = a.join(b, F.col("a.node") == F.col("b.node"), "full")
    differ = joined.where(~F.col("a.sums").eqNullSafe(F.col("b.sums")))
    return sorted(row[0] for row in differ.select(F.coalesce("a.node", "b.node")).collect())


def differing_buckets(old: Fingerprint, new: Fingerprint) -> list[int]:
    """Down the tree from its root: only children of nodes that differ are compared."""
    if old.buckets != new.buckets or old.key != new.key:
        raise ValueError("fingerprints of different keys or numbers of buckets")
    level = 0
    while FANOUT**level < old.buckets:
        level += 1
    found = differing_nodes(old, new, level)
    while found and level:
        level -= 1
        found = differing_nodes(old, new, level, found)
    return found


def open_buckets(side: Fingerprint, buckets: Sequence[int]) -> DataFrame:
    """The rows of some buckets; no file of another one is read."""
    return side.rows.where(F.col("bucket").isin(list(buckets)))


def differing_rows(old: Fingerprint, new: Fingerprint) -> DataFrame:
    """``<key>, row_hash, n_old, n_new`` of rows that one version holds more often than the other."""
    buckets = differing_buckets(old, new)
    sides = [
        open_buckets(side, buckets).withColumn("n_old", F.lit(1 - place)).withColumn("n_new", F.lit(place))
        for place, side in enumerate((old, new))
    ]
    counted = sides[0].unionByName(sides[1]).groupBy(*old.key, "row_hash").agg(
        F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new")
    )
    return counted.where("n_old <> n_new")
