"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import pytest

from tableferry.llm import spelling

SCHEMA = "doc_id long, text string, word int, cell string, n double"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 1.0) for d, t in rows], SCHEMA)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    form, n_near = {}, {}
    for w, n in words.items():
        others = [x for x in words if abs(len(x) - len(w)) < 2 and near(w, x)]
        n_near[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), n, n_near[w], form[w] and words[form[w]]) for w, n in words.items())


def rows_of(found):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect())


def mixed(n=400):
    draw = random.Random(5)
    stems = ["".join(draw.choice("abcdeéÿ") for _ in range(draw.randint(6, 11))) for _ in range(40)]
    rows = []
    for doc_id in range(n):
        words = []
        for _ in range(30):
            word = draw.choice(stems[:: draw.choice([1, 1, 1, 7])])
            for _ in range(draw.choice([0, 0, 0, 0, 1, 2])):
                at = draw.randrange(len(word))
                word = draw.choice([word[:at] + word[at + 1 :], word[:at] + "a" + word[at:], word[:at] + "b" + word[at + 1 :]])
            words.append(word.capitalize() if draw.random() < 0.1 else word)
        rows.append((doc_id, draw.choice([" ", ", ", "1"]).join(words)))
    return rows


@pytest.mark.parametrize("block", [4, spelling.BLOCK])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    rows = mixed()
    assert rows_of(spelling.spelling_variants(frame(spark, rows))) == plain(rows)


def test_forms_are_followed_to_the_root(spark):
    rows = [(1, "abcdefgh " * 300 + "abcdefgx " * 25 + "abcdefyx " * 2 + "abcdezyx " * 2)]
    found = rows_of(spelling.spelling_variants(frame(spark, rows)))
    assert found == plain(rows)
    assert {(w, r) for w, _, r, *_ in found} >= {("abcdefyx", "abcdefgh"), ("abcdezyx", "abcdezyx")}


def test_odd_rows(spark):
    long = "ab" * 1500
    rows = [
        (None, None), (None, "Résumée résumée"), (3, ""), (3, ""), (4, "1 2 ,"), (5, "ABCDEFG abcdefg abcdefh " * 40),
        (5, "ABCDEFG abcdefg abcdefh " * 40), (6, f"{long} {long} {long}c {long}c"), (7, "ÀÀÀÀÀÀÀ×÷ ààààààà " * 3),
    ]
    assert rows_of(spelling.spelling_variants(frame(spark, rows))) == plain(rows)
    assert spelling.spelling_variants(frame(spark, rows).limit(0)).count() == 0
    assert spelling.spelling_variants(frame(spark, [(1, "short one")])).count() == 0


def test_any_two_cells_meet_once():
    taken = [(0,) * spelling.CLASSES, *spelling.steps()]
    opposite = [tuple(-x for x in step) for step in spelling.steps()]
    assert len(set(taken + opposite)) == len(taken) + len(opposite)
