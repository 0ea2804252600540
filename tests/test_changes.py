"""Change sets: applied to the old version they give the new one, whatever repeats or is null."""

import random
from collections import Counter

import pytest

from tableferry.operators.changes import DELETE, INSERT, UPDATE, apply_changes, change_sets

SCHEMA = "k int, op string, v double, part string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def check(spark, old, new, key=("k",)):
    a, b = frame(spark, old), frame(spark, new)
    changes = change_sets(a, b, key)
    assert rows_of(apply_changes(a, changes)) == Counter(map(tuple, new))
    return changes.collect()


def test_each_kind(spark):
    old = [(1, "a", 1.0, "x"), (2, "b", 2.0, "x"), (3, "c", 3.0, "x")]
    new = [(1, "a", 1.0, "x"), (2, "b", 2.5, "x"), (4, "d", None, "x")]
    found = {r.row.k: (r.op, r.copies, r.row.v) for r in check(spark, old, new)}
    assert found == {2: (UPDATE, 1, 2.5), 3: (DELETE, 1, 3.0), 4: (INSERT, 1, None)}


def test_nulls_and_repeats(spark):
    same = (7, "s", 0.0, "x")
    old = [same] * 5 + [(None, "n", 1.0, "x"), (None, "n", 1.0, "x"), (8, "a", 1.0, "x"), (8, "b", 1.0, "x")]
    new = [same] * 2 + [(None, "n", 1.0, "x"), (None, "m", None, "x"), (8, "a", 1.0, "x"), (8, "c", 1.0, "x")]
    found = Counter((r.op, r.copies, r.row.k, r.row.op) for r in check(spark, old, new))
    assert found == Counter(
        [(DELETE, 3, 7, "s"), (DELETE, 1, None, "n"), (INSERT, 1, None, "m"), (UPDATE, 1, 8, "c")]
    )


@pytest.mark.parametrize("seed", range(4))
def test_random_versions(spark, seed):
    draw = random.Random(seed)

    def version():
        return [
            (draw.choice([None, 1, 1, 1, 2, 3, 4, 5]), draw.choice("ab"), draw.choice([None, 0.0, 1.5]), draw.choice("xy"))
            for _ in range(draw.choice([0, 1, 60]))
        ]

    old = version()
    check(spark, old, version())
    check(spark, old, version(), ("k", "part"))
    assert check(spark, old, old) == []


def test_versions_with_other_columns_are_refused(spark):
    with pytest.raises(ValueError, match="different columns"):
        change_sets(frame(spark, []), frame(spark, []).drop("v"), ["k"])


def test_all_rows_are_added_up_before_they_are_shuffled(spark):
    a = frame(spark, [(1, "a", 1.0, "x")])
    plan = change_sets(a, a, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(sign" in plan and "Window" not in plan and "Cartesian" not in plan
