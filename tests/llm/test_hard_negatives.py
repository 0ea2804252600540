"""Hard negatives against a brute-force version; the curve and the bounds by themselves."""

import itertools
import math
import random
from collections import Counter

import numpy as np

from tableferry.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, q string, block double, grp int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, n, "x", 1.0, 1) for i, v, n in rows], SCHEMA)


def plain(rows):
    taken = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        taken.append((vec_id, [math.floor(256 * x) for x in vector], label))

    def first(found, n):
        return sorted(found, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:n]

    out = Counter()
    for a, (anchor, va, la) in enumerate(taken):
        if anchor is None or anchor % 50:
            continue
        scored = [
            (sum(x * y for x, y in zip(va, v)), vec_id, label)
            for b, (vec_id, v, label) in enumerate(taken)
            if a != b
        ]
        for positive, positive_id, _ in first([s for s in scored if s[2] == la], 5):
            inside = [s for s in scored if s[2] != la and 50 * positive <= 100 * s[0] <= 95 * positive]
            for rank, (score, vec_id, _) in enumerate(first(inside, 3), 1):
                out[anchor, positive_id, rank, vec_id, positive, score] += 1
    return out


def rows_of(found):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return Counter(tuple(r[n] for n in names) for r in found.collect())


def test_curve_goes_from_neighbour_to_neighbour():
    cells = np.array(list(itertools.product(range(16), repeat=3)))
    keys = hard_negatives.hilbert(cells)
    order = sorted(range(len(keys)), key=lambda i: keys[i])
    assert len(set(keys)) == len(keys)
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_product():
    draw = np.random.default_rng(1)
    rows = draw.integers(-300, 300, (40, 5))
    anchors = draw.integers(-300, 300, (7, 5))
    least, greatest = hard_negatives.bounds(anchors, rows.min(axis=0)[None], rows.max(axis=0)[None])
    scores = anchors @ rows.T
    assert (least <= scores.min(axis=1)[:, None]).all() and (greatest >= scores.max(axis=1)[:, None]).all()
    large = draw.integers(-(1 << 28), 1 << 28, (3, 64))
    assert hard_negatives.products(large, large).tolist() == [
        [sum(int(x) * int(y) for x, y in zip(a, b)) for b in large] for a in large
    ]


def clustered(n=1800, dims=4):
    """Vectors around a few centres, in steps so coarse that scores tie."""
    draw = random.Random(11)
    centres = [[draw.uniform(-1, 1) for _ in range(dims)] for _ in range(12)]
    return [
        (i, [round(c + draw.gauss(0, 0.1), 1) for c in draw.choice(centres)], draw.randrange(6)) for i in range(n)
    ]


def test_equals_brute_force_over_many_blocks(spark):
    rows = clustered()
    found = rows_of(hard_negatives.hard_negatives(frame(spark, rows)))
    assert found == plain(rows) and sum(found.values()) > 200


def test_blocks_out_of_reach_are_not_picked(spark):
    rows = [(i, [1.0 + i % 5 / 100, 0.0], 1) for i in range(1, 3000)]
    rows += [(3000 + i, [-1.0, i % 7 / 100], 1) for i in range(3000)]
    blocks = hard_negatives.in_blocks(hard_negatives.cleaned(frame(spark, rows)))
    anchor = np.array([[256, 0]])
    group = anchor, np.array([1]), np.array([-1]), np.array([[[200 * 256, hard_negatives.HIGHEST]]])
    zones = [r.asDict() for r in blocks.select("block", "bundle", "lab_lo", "lab_hi", "lo", "hi").collect()]
    picked = [b for batch in hard_negatives._picked(True, 0, group, zones) for b in batch.to_pylist()]
    reached = {b for pick in picked for b in pick["blocks"]}
    assert len(zones) > 20 and len(zones) // 3 < len(reached) < 2 * len(zones) // 3


def test_odd_rows(spark):
    draw = random.Random(2)
    rows = [(i, [draw.choice([0.0, 0.5, -0.5, 1.0]) for _ in range(3)], draw.randrange(3)) for i in range(120)]
    rows += rows[40:60] + [(50, [0.5, 0.5, 0.5], 1), (50, [0.5, 0.5, 0.5], 1), (50, None, 1), (100, [0.5], None)]
    rows += [(None, [1.0, 1.0, 1.0], n) for n in (0, 1, 2)]
    rows += [(200, [0.5, None, 0.5], 1), (201, [float("nan")] * 3, 1), (202, [float("inf"), 0.0, 0.0], 2)]
    rows += [(250, [], 1), (251, [1.0], 2), (252, [1.0, 1.0, 1.0, 9.0], 1), (300, [-1.0, -1.0, -1.0], -1)]
    assert rows_of(hard_negatives.hard_negatives(frame(spark, rows))) == plain(rows)
    huge = frame(spark, [*rows, (350, [1e30, 0.0, 0.0], 1)])  # leaves 64 bits: takes no part
    assert rows_of(hard_negatives.hard_negatives(huge)) == plain(rows)


def test_empty_tables(spark):
    assert hard_negatives.hard_negatives(frame(spark, [(1, [1.0], 1)]).limit(0)).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(50, None, None)])).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(50, [], 1), (51, [], 1)])).count() == 0
