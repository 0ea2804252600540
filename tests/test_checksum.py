"""Checksums, and the tree from a table's checksum down to its rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tableferry.operators import checksum
from tableferry.operators.checksum import Fingerprint, differing_buckets, differing_nodes, differing_rows, table_checksum

SCHEMA = "k int, bucket_name string, v double"


def rows(n):
    return [(i if i % 9 else None, f"name {i % 4}", i / 7) for i in range(n)]


def frame(spark, content):
    return spark.createDataFrame(content, SCHEMA)


def value(df):
    return table_checksum(df).first().checksum


def prints(spark, tmp_path, *versions, **options):
    return [
        Fingerprint(spark, str(tmp_path / f"v{i}"), ["k"], **options).write(frame(spark, v), files=2)
        for i, v in enumerate(versions)
    ]


def test_order_does_not_matter_and_repeats_do(spark):
    content = rows(200)
    whole = value(frame(spark, content))
    assert whole == value(frame(spark, content[::-1]).repartition(7))
    assert whole != value(frame(spark, [*content, content[5]]))
    # The same number of rows, one repeated in place of another.
    assert whole != value(frame(spark, [*content[:-1], content[5]]))
    assert value(frame(spark, [])) == "0:0:0"


def test_sums_are_of_unsigned_halves(spark):
    hashes = ["f" * 32, "0" * 15 + "2" + "8" + "0" * 15]
    row = spark.createDataFrame([(h,) for h in hashes], "h string").agg(*checksum.sums_of("h")).first()
    assert row.sum_high == Decimal(2**64 - 1 + 2) and row.sum_low == Decimal(2**64 - 1 + 2**63)


def test_one_row_of_each_task_is_shuffled(spark):
    df = frame(spark, rows(10))
    plan = table_checksum(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_altered_rows_are_found_at_equal_counts(spark, tmp_path):
    old = rows(3000)
    new = list(old)
    for place in (10, 1500, 9):  # the last one without a key
        new[place] = (*new[place][:2], -1.0)
    a, b = prints(spark, tmp_path, old, new)
    buckets = differing_buckets(a, b)
    assert 2 <= len(buckets) <= 4
    found = {(r.k, r.n_old, r.n_new) for r in differing_rows(a, b).collect()}
    assert found == {(k, *n) for k in (10, 1500, None) for n in ((1, 0), (0, 1))}


def test_only_children_of_differing_nodes_are_compared(spark, tmp_path):
    old = rows(500)
    a, b = prints(spark, tmp_path, old, [*old[:-1], (499, "other", 0.0)], buckets=64)
    (bucket,) = differing_buckets(a, b)
    assert differing_nodes(a, b, 1) == [bucket // checksum.FANOUT]
    other = (bucket // checksum.FANOUT + 1) % 4
    assert differing_nodes(a, b, 0, [other]) == []


def test_no_file_of_another_bucket_is_read(spark, tmp_path):
    old = rows(500)
    a, b = prints(spark, tmp_path, old, [*old[:-1], (499, "other", 0.0)])
    opened = checksum.open_buckets(a, differing_buckets(a, b))
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    read = opened.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(read) <= 2 and a.rows.select(F.input_file_name()).distinct().count() > 100


def test_equal_versions_and_missing_rows(spark, tmp_path):
    old = rows(300)
    a, b, c = prints(spark, tmp_path, old, old[::-1], old[:100])
    assert differing_buckets(a, b) == [] and differing_rows(a, b).count() == 0
    assert differing_rows(a, c).agg(F.sum("n_old")).first()[0] == 200


def test_fingerprints_of_other_keys_are_refused(spark, tmp_path):
    a = Fingerprint(spark, str(tmp_path), ["k"])
    with pytest.raises(ValueError, match="different keys"):
        differing_buckets(a, Fingerprint(spark, str(tmp_path), ["v"]))
