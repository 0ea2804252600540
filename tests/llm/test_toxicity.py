"""Toxicity: features and ratios against plain versions, held-out accuracy, odd rows."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableferry.llm import toxicity

DATA = "/root/testdata/sf0.1"
DOCUMENTS = "doc_id long, text string, labelled string, toxic string, fit double, score string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "x", 1.0, "x") for d, t in rows], DOCUMENTS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, quality int")


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def examples(n=300):
    """Every third text holds a word that the others lack."""
    words = [f"{a}{b}ing" for a in "bdfgklm" for b in "aeiou"]
    rows = []
    for i in range(n):
        text = [words[(i * k) % 35] for k in range(1, 12)]
        rows.append((i, " ".join([*text, "rotten", *text[:3]] if i % 3 == 0 else text)))
    return rows


def plain_features(text):
    text = re.sub(r"[^a-zäöüß]+", " ", f" {text.lower()} ")
    return {
        text[i : i + n]
        for n in toxicity.ORDERS
        for i in range(len(text) - n + 1)
        if " " not in text[i + 1 : i + n - 1]
    }


def test_features_are_the_grams_inside_words(monkeypatch):
    for text in ("", "a", "Rotten apple!!", "zz  zz, yyyyyyyyyy", "Müll-Wörter " * 40):
        found = toxicity.features(text)
        assert len(found) == len(plain_features(text))
        assert set(toxicity.features(text + " more")) >= set(found)
        whole = found.tolist()
        monkeypatch.setattr(toxicity, "SLICE", 7)
        assert toxicity.features(text).tolist() == whole
        monkeypatch.undo()


def test_counts_and_ratios(spark):
    rows = examples()
    marks = [(i, int(i % 3 == 0), 0) for i, _ in rows]
    counts, texts = toxicity.counted(toxicity.labelled_texts(frame(spark, rows), labels(spark, marks)))
    train = [(i, t) for i, t in rows if not held(i)]
    assert texts.tolist() == [sum(i % 3 != 0 for i, _ in train), sum(i % 3 == 0 for i, _ in train)]
    grams = Counter((g, i % 3 == 0) for i, t in train for g in plain_features(t))
    for label in (0, 1):
        held_by = sorted(n for (_, toxic), n in grams.items() if toxic == label)
        assert sorted(counts[label][counts[label] > 0].tolist()) == held_by
    clean, toxic = texts
    more = clean / toxic
    plain = []
    for gram in {gram for gram, _ in grams}:
        n = [grams[gram, False], grams[gram, True]]
        ratio = math.log((n[1] + 1) / (toxic + 2)) - math.log((n[0] + more) / (clean + 2 * more))
        sure = abs(ratio) - 1.64 * math.sqrt(1 / (n[1] + 1) + 1 / (n[0] + more))
        plain.append(math.copysign(max(0, sure), ratio))
    ratios = toxicity.ratios_of(counts, texts)
    assert np.allclose(np.sort(ratios[counts.sum(axis=0) > 0]), np.sort(plain))
    assert ratios.max() > 1


def test_learns_and_leaves_held_out_labels_alone(spark):
    rows = examples()
    marks = [(i, int(i % 3 == 0), 0) for i, _ in rows]
    turned = [(i, 1 - t if held(i) else t, q) for i, t, q in marks]
    found = toxicity.toxicity(frame(spark, rows), labels(spark, marks)).collect()
    other = toxicity.toxicity(frame(spark, rows), labels(spark, turned)).collect()
    assert sorted(found) == sorted(other)
    assert all(r.held_out == held(r.doc_id) for r in found)
    assert all(r.predicted == (r.doc_id % 3 == 0) == (r.score >= 0.5) for r in found)


def test_odd_rows(spark):
    rows = examples()
    marks = [(i, int(i % 3 == 0), 0) for i, _ in rows] + [(None, 1, 0), (2, None, 1), (1, 0, 0), (5, 7, 0)]
    odd = [*rows, (None, None), (None, "rotten"), (7, ""), (7, ""), (8, "\n \t"), (9, "rotten " * 50_000)]
    found = toxicity.toxicity(frame(spark, odd), labels(spark, marks))
    assert found.count() == len(odd) and found.where("score IS NULL OR score < 0 OR score > 1").isEmpty()
    assert not found.where("doc_id IS NULL").where("held_out").count()
    empty = {r.score for r in found.where("doc_id = 7").collect() if r.score < 0.5}
    assert len(empty) == 1
    assert toxicity.toxicity(frame(spark, odd).limit(0), labels(spark, marks)).count() == 0
    for few in ([], [(1, 0, 0)], [(1, 1, 0)]):
        assert {r.score for r in toxicity.toxicity(frame(spark, odd), labels(spark, few)).collect()} <= {
            toxicity.NOTHING.score(np.zeros(0, np.uint32))
        }


def test_a_repeated_id_does_not_come_to_the_driver_whole(spark):
    rows = examples() + [(3, f"rotten number {i}") for i in range(500)]
    marks = [(i, int(i % 3 == 0), 0) for i, _ in examples()]
    texts = toxicity.labelled_texts(frame(spark, rows), labels(spark, marks))
    sample = toxicity.sampled(texts, np.ones(toxicity.PLACES, dtype=bool))
    ids = [r["doc_id"] for r in sample]
    assert len(ids) == len(set(ids)) and 3 in ids


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_accuracy_on_what_is_held_out(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    marks = spark.read.parquet(f"{DATA}/labels.parquet")
    found = toxicity.toxicity(documents, marks).where("held_out").join(marks, "doc_id")
    row = found.agg(
        F.expr("count_if(toxic = 1) AS toxic"),
        F.expr("count_if(toxic = 1 AND predicted = 1) AS caught"),
        F.expr("count_if(toxic = 0 AND predicted = 1) AS wrong"),
    ).first()
    assert row.caught >= 0.88 * row.toxic and row.wrong <= 0.06 * row.caught
