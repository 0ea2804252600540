"""Near copies among rows without an id, and rows that repeat one."""

from collections import Counter

import pytest

from tableferry.llm import common, near_dups
from tests.llm.test_operators import plain_near_dups

SCHEMA = "doc_id long, text string, node string"
BASE = [f"w{i}" for i in range(120)]


def text(shift: int, base=BASE) -> str:
    """0 and 1 are near copies, and 1 and 2 (108 of 124 runs), but not 0 and 2 (100 of 132)."""
    words = list(base)
    if shift:
        words[-8:] = [f"x{i}" for i in range(8)]
    if shift == 2:
        words[:8] = [f"y{i}" for i in range(8)]
    return " ".join(words)


OTHER = [f"v{i}" for i in range(120)]
ROWS = [
    (1, text(0)),
    (None, text(1)),  # the bridge
    (3, text(2)),
    (None, text(0, OTHER)),  # near copies without any id
    (None, text(1, OTHER)),
    (None, text(1, OTHER)),
    (7, "once more the same row " * 9),
    (7, "once more the same row " * 9),
    (8, "a text of its own for eight"),
    (8, text(0) + " end"),  # the same id, a copy of 1
    (9, None),
    (9, None),
    (None, " "),
]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(d, t, "n") for d, t in ROWS], SCHEMA)


def test_rows_without_an_id_link(frame):
    found = near_dups.near_duplicates(frame, 85)
    assert Counter(map(tuple, found.collect())) == plain_near_dups(ROWS)
    assert {r.component_id for r in found.collect() if r.doc_id == 3} == {1}


def test_one_row_of_each_component(frame):
    rows = near_dups.one_of_each(frame)
    assert rows.columns == frame.columns
    kept = [(r.doc_id, r.text) for r in rows.collect()]
    assert sorted(d for d, _ in kept if d is not None) == [1, 7, 8, 9, 9]
    assert (8, ROWS[8][1]) in kept
    nameless = [t for d, t in kept if d is None]
    assert len(nameless) == 2 and " " in nameless
    assert near_dups.one_of_each(frame.limit(0)).count() == 0


def test_a_row_without_an_id_is_not_the_row_of_id_0(spark):
    named = [(0, text(0)), (0, text(0, OTHER)), (0, text(0, OTHER))]
    rows = [*named, (None, text(0, OTHER)), (None, "nobody's words")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in near_dups.one_of_each(frame).collect()]
    assert Counter(kept) == Counter([*named[:2], rows[-1]])


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_documents_are_dealt_out_by_id_only_for_many_ids(frame, spark, monkeypatch, limit):
    """As for large tables, nothing is small enough to be broadcast of itself."""
    wanted = Counter((r.doc_id, r.text) for r in near_dups.one_of_each(frame).collect())
    monkeypatch.setattr(common, "BROADCAST_IDS", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = near_dups.one_of_each(frame)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        found = Counter((r.doc_id, r.text) for r in rows.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("Exchange hashpartitioning(doc_id" in plan) == (limit == 0)
    # By node and id the rows are dealt out once, those of repeated ids and those without one.
    assert "coalesce(number" not in plan
    assert found == wanted
