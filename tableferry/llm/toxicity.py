"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is a hashed n-gram that lies inside a word or reaches its edge. Every labelled training
document counts once for each of its features. The ratio of the two smoothed shares, on a logarithmic
scale and drawn towards zero by :data:`SURE` standard errors, scales the feature: what the counts do not
tell apart has no weight at all, so that long texts gather no noise. On the scaled features, brought
to about one length, a logistic regression is fitted on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: n-grams are hashed into so many places.
PLACES = 1 << 20
ORDERS = (3, 4, 6, 8)
#: Bounds of the labelled rows, per class: for the counts, and of these for the fit.
COUNT_ROWS = 400_000
FIT_ROWS = 3_000
#: Added to each count of the toxic class, and in proportion to the clean one.
SMOOTHING = 1.0
#: Standard errors by which a ratio is drawn towards zero.
SURE = 1.64
#: Length of the scaled features of a text that has many; one that has few stays shorter.
LENGTH, FEW = 3.0, 4.0
ROUNDS, STEP, RIDGE = 120, 0.05, 1e-5
#: Characters looked at in one go; the next go begins as far back as the longest n-gram reaches.
SLICE = 1 << 20
#: Places whose counts travel as one row.
BLOCK = 1 << 12

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_LETTERS = np.array([chr(c).isalpha() for c in range(0x10000)], dtype=bool)
_MIX = np.uint32(2654435761)
_SPACE = np.uint32(0x20)


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def _grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the n-grams of one run of characters, order by order, with repeats."""
    letters = _LETTERS[np.minimum(codes, 0xFFFF)] | (codes > 0xFFFF)
    codes = np.where(letters, codes, _SPACE)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = letters[1:] | letters[:-1]
    codes = codes[keep]
    spaces = np.concatenate([[0], np.cumsum(codes == _SPACE, dtype=np.int32)])
    value = np.zeros(len(codes), dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        size = len(codes) - order + 1
        if size < 1:
            return
        value = (value[:size] + codes[order - 1 :]) * _MIX
        value ^= value >> np.uint32(15)
        if order in ORDERS:
            # No space but at the ends.
            whole = spaces[order - 1 : order - 1 + size] == spaces[1 : 1 + size]
            yield value[whole] & np.uint32(PLACES - 1)


def features(text: str | None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Places of the n-grams of the whole text, each once, sorted; only ``wanted`` ones if given."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    found = [np.zeros(0, dtype=np.uint32)]
    for at in range(0, len(codes), SLICE):
        part = codes[max(0, at - max(ORDERS) + 1) : at + SLICE]
        for places in _grams(part):
            found.append(places if wanted is None else places[wanted[places]])
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Model:
    """Places with a ratio (sorted), their ratios and weights, and the constant."""

    places: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    constant: float

    @property
    def wanted(self) -> np.ndarray:
        marks = np.zeros(PLACES, dtype=bool)
        marks[self.places] = True
        return marks

    def score(self, found: np.ndarray) -> float:
        """Of a text by its wanted features."""
        at = np.searchsorted(self.places, found)
        margin = float(scaled(self.ratios[at]) @ self.weights[at]) + self.constant
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


#: What is learned from labels of one class or none.
NOTHING = Model(np.zeros(0, np.uint32), np.zeros(0), np.zeros(0), -500.0)


def scaled(ratios: np.ndarray) -> np.ndarray:
    return ratios * (LENGTH / np.sqrt(FEW + float(ratios @ ratios)))


def chosen_labels(labels: DataFrame) -> DataFrame:
    """``labelled, toxic, fit``: at most ``COUNT_ROWS`` ids of each class that are not held out.

    An id with several labels is toxic if one of them says so. The choice is by a hash of the id;
    the first ``FIT_ROWS`` of each class are for the fit.
    """
    rank = Window.partitionBy("toxic").orderBy(F.xxhash64("labelled"), "labelled")
    return (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("labelled"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= COUNT_ROWS)
        .select("labelled", "toxic", (F.col("rank") <= FIT_ROWS).alias("fit"))
    )


def labelled_texts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic, fit`` of the chosen labels; their ids are bounded, so they are broadcast."""
    ids = F.broadcast(chosen_labels(labels))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.join(ids, F.col("doc_id") == F.col("labelled")).drop("labelled")


COUNTS = "block int, clean binary, toxic binary, texts array<long>"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, PLACES), dtype=np.int64)
    texts = [0, 0]
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic][features(text.as_py())] += 1
            texts[toxic] += 1
    yield from _count_rows(counts, texts)


def _count_rows(counts: np.ndarray, texts: list[int]) -> Iterator[pa.RecordBatch]:
    """Blocks of places that have counts; block -1 holds the number of texts."""
    used = [b for b in range(PLACES // BLOCK) if counts[:, b * BLOCK : (b + 1) * BLOCK].any()]
    parts = [[counts[label, b * BLOCK : (b + 1) * BLOCK].tobytes() for b in used] for label in (0, 1)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([-1, *used], pa.int32()),
            pa.array([None, *parts[0]], pa.binary()),
            pa.array([None, *parts[1]], pa.binary()),
            pa.array([texts, *([None] * len(used))], pa.list_(pa.int64())),
        ],
        names=["block", "clean", "toxic", "texts"],
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, PLACES), dtype=np.int64)
    texts = [0, 0]
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] < 0:
                texts = [a + b for a, b in zip(texts, row["texts"], strict=True)]
                continue
            at = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
            for label, name in enumerate(("clean", "toxic")):
                counts[label, at] += np.frombuffer(row[name], dtype=np.int64)
    yield from _count_rows(counts, texts)


def counted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How many texts of each class hold a place, and how many there are.

    Tasks add up their own texts, a shuffle by block adds up the tasks; what comes to the driver is
    bounded by ``PLACES``.
    """
    parts = rows.select("text", "toxic").mapInArrow(_counted, COUNTS)
    summed = parts.repartition("block").mapInArrow(_added, COUNTS)
    counts, texts = np.zeros((2, PLACES)), np.zeros(2)
    for row in summed.where("block >= 0 OR texts[0] + texts[1] > 0").collect():
        if row["block"] < 0:
            texts += row["texts"]
            continue
        at = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
        for label, name in enumerate(("clean", "toxic")):
            counts[label, at] += np.frombuffer(row[name], dtype=np.int64)
    return counts, texts


def ratios_of(counts: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Log-count ratio of toxic over clean of each place, drawn towards zero."""
    clean, toxic = texts
    more = SMOOTHING * clean / toxic
    ratio = np.log((counts[1] + SMOOTHING) / (toxic + 2 * SMOOTHING))
    ratio -= np.log((counts[0] + more) / (clean + 2 * more))
    error = np.sqrt(1 / (counts[1] + SMOOTHING) + 1 / (counts[0] + more))
    ratio = np.sign(ratio) * np.maximum(0, np.abs(ratio) - SURE * error)
    ratio[counts.sum(axis=0) == 0] = 0
    return ratio


def sampled(rows: DataFrame, wanted: np.ndarray) -> list:
    """``doc_id, toxic, places`` (32-bit numbers) of the documents chosen for the fit, one row of each id."""
    marks = rows.sparkSession.sparkContext.broadcast(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [features(t.as_py(), marks.value) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic"),
                    pa.array([p.astype("<u4").tobytes() for p in places], pa.binary()),
                ],
                names=["doc_id", "toxic", "places"],
            )

    found = rows.where("fit").mapInArrow(work, "doc_id long, toxic int, places binary")
    order = Window.partitionBy("doc_id").orderBy("places")
    one = found.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return sorted(one.select("doc_id", "toxic", "places").collect(), key=lambda r: r["doc_id"])


def solve(rows: list, ratios: np.ndarray) -> Model:
    """Logistic regression on the scaled features; both classes weigh the same."""
    places = np.flatnonzero(ratios)
    column_of = np.zeros(PLACES, dtype=np.int32)
    column_of[places] = np.arange(len(places))
    texts = [np.frombuffer(r["places"], dtype="<u4") for r in rows]
    labels = np.array([r["toxic"] for r in rows], dtype=np.float64)
    share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    values = np.concatenate([scaled(ratios[t]).astype(np.float32) for t in texts])
    column = np.concatenate([column_of[t] for t in texts])
    row = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    weights, constant = np.full(len(places), STEP), 0.0
    size, size_constant = np.full(len(places), 1e-10), 1e-10
    for _ in range(ROUNDS):
        margin = np.bincount(row, values * weights[column], minlength=len(texts)) + constant
        error = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels) * share
        slope = np.bincount(column, values * error[row], minlength=len(places)) + RIDGE * weights
        size += slope**2
        size_constant += error.sum() ** 2
        weights -= STEP * slope / np.sqrt(size)
        constant -= 2 * STEP * error.sum() / np.sqrt(size_constant)
    return Model(places.astype(np.uint32), ratios[places], weights, float(constant))


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Learn from the text and ``toxic`` of documents that are not held out."""
    rows = labelled_texts(documents, labels)
    counts, texts = counted(rows)
    if not texts.all():
        return NOTHING
    ratios = ratios_of(counts, texts)
    sample = sampled(rows, ratios != 0)
    if len({r["toxic"] for r in sample}) < 2:
        return NOTHING
    return solve(sample, ratios)


def toxicity(documents: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    A null or empty text has no features and the score of the constant. Where the labels do not
    hold both classes nothing can be learned, and every score is 0. A null id is never held out and
    never learned from. Every row stands for itself; further columns are ignored. The model is
    bounded by ``PLACES`` and broadcast.
    """
    model = model or fit(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        wanted = learned.wanted
        for batch in batches:
            scores = [learned.score(features(t.as_py(), wanted)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "text",
    )
    return rows.mapInArrow(work, SCHEMA)
