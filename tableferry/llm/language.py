"""Language identification by a string kernel with Nyström landmarks.

The kernel of two texts is the number of distinct character n-grams (one to three characters) that
both hold, over the geometric mean of how many each holds. A bounded sample of labelled documents gives
landmarks and the rows that one-versus-rest kernel ridge regression is fitted on; texts are scored in
batches, presence times landmarks times weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.common import tidy

#: n-grams are hashed into so many places.
PLACES = 1 << 15
ORDERS = (1, 2, 3)
#: Bounds of the labelled sample: landmarks, and rows for the fit, per language (about).
LANDMARKS = 24
FIT_ROWS = 300
#: Languages with fewer labelled rows are learned from what there is; of more languages than this, those
#: with the most labelled rows are learned.
MAX_LANGUAGES = 400
RIDGE = 1e-2
#: Texts scored at a time.
ROWS = 64
UNDETERMINED = "und"
#: A filtering stage rejects what is undetermined or less sure than this.
REJECT_BELOW = 0.35

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
LETTER = regex.compile(r"\p{L}")
_MIX = np.uint32(2654435761)


def presence(text: str) -> np.ndarray:
    """Places of the n-grams of the whole text, each once, sorted.

    Runs of anything but letters count as one space; case is dropped.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(_letters(codes), codes, np.uint32(0x20))
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0x20) | (codes[:-1] != 0x20)
    codes = codes[keep]
    marks = np.zeros(PLACES, dtype=bool)
    value = np.zeros(len(codes), dtype=np.uint32)
    for order in ORDERS:
        if len(codes) < order:
            break
        value = (value[: len(codes) - order + 1] + codes[order - 1 :]) * _MIX
        value ^= value >> np.uint32(15)
        marks[value & np.uint32(PLACES - 1)] = True
    return np.flatnonzero(marks).astype(np.int32)


_LETTERS = np.array([chr(c).isalpha() for c in range(0x10000)], dtype=bool)


def _letters(codes: np.ndarray) -> np.ndarray:
    """Letters of the basic plane; what lies beyond it counts as letters."""
    return _LETTERS[np.minimum(codes, 0xFFFF)] | (codes > 0xFFFF)


def dense(rows: list[np.ndarray]) -> np.ndarray:
    """Unit rows of the presence kernel's feature space."""
    out = np.zeros((len(rows), PLACES), dtype=np.float32)
    for row, places in zip(out, rows, strict=True):
        if len(places):
            row[places] = 1.0 / np.sqrt(len(places))
    return out


@dataclass(frozen=True)
class Model:
    """Landmarks (unit rows), Nyström map and ridge weights folded into one matrix, and languages."""

    languages: tuple[str, ...]
    landmarks: np.ndarray  # landmarks x places
    weights: np.ndarray  # landmarks + 1 (constant) x languages

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        kernel = dense(rows) @ self.landmarks.T
        return kernel @ self.weights[:-1] + self.weights[-1]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        if known and self.languages:
            margins = self.margins([presence(texts[i]) for i in known])
            best = margins.argmax(axis=1)
            sure = np.clip((margins.max(axis=1) + 1) / 2, 0, 1)
            for i, place, value in zip(known, best.tolist(), sure.tolist(), strict=True):
                out[i] = self.languages[place], value
        return out


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def sample(documents: DataFrame) -> list:
    """Presence of a bounded choice of labelled documents, at most so many of each language.

    The choice is by a hash of id and text within the share that the language's size allows, so it is
    made where the rows are; of rows with equal hashes, too, no more than wanted are taken. Only places
    of n-grams come to the driver.
    """
    training = documents.where(F.col("lang").isNotNull() & ~F.coalesce(held_out(), F.lit(False)))
    counted = training.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES)
    sizes = {r["lang"]: r["count"] for r in counted.collect()}
    wanted = LANDMARKS + FIT_ROWS
    rank = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000_000))
    share = F.lit(0)
    for lang, size in sorted(sizes.items()):
        share = F.when(F.col("lang") == lang, int(1e9 * min(1.0, 1.2 * wanted / size))).otherwise(share)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [presence(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("rank"), pa.array(rows, pa.list_(pa.int32()))],
                names=["lang", "rank", "places"],
            )

    order = Window.partitionBy("lang").orderBy("rank")
    chosen = (
        training.where(rank < share)
        .select("text", "lang", rank.alias("rank"))
        .withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= wanted)
        .select("text", "lang", "rank")
    )
    found = chosen.mapInArrow(work, "lang string, rank long, places array<int>").collect()
    return sorted(found, key=lambda r: (r["rank"], r["lang"], r["places"]))


def fit(documents: DataFrame) -> Model:
    """Learn from text and ``lang`` of the documents that are not held out."""
    rows = [r for r in sample(documents) if r["places"]]
    languages = tuple(sorted({r["lang"] for r in rows}))
    if not languages:
        return Model((), np.zeros((0, PLACES), np.float32), np.zeros((1, 0), np.float32))
    chosen = [r for lang in languages for r in [x for x in rows if x["lang"] == lang][:LANDMARKS]]
    landmarks = dense([np.array(r["places"]) for r in chosen])
    kernel = np.concatenate(
        [
            dense([np.array(r["places"]) for r in rows[at : at + 256]]) @ landmarks.T
            for at in range(0, len(rows), 256)
        ]
    ).astype(np.float64)
    # Nyström: features K W^-1/2, with W the kernel of the landmarks (small directions left out).
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    large = values > 1e-6 * values.max()
    root = vectors[:, large] / np.sqrt(values[large])
    features = np.c_[kernel @ root, np.ones(len(rows))]
    labels = np.array([[1.0 if r["lang"] == lang else -1.0 for lang in languages] for r in rows])
    # Each language's rows weigh as much as all others together.
    solved = []
    for place in range(len(languages)):
        own = labels[:, place] > 0
        weight = np.where(own, 0.5 / max(1, own.sum()), 0.5 / max(1, (~own).sum()))
        scaled = features * weight[:, None]
        ridge = RIDGE * np.eye(features.shape[1]) / max(1, len(rows)) * 10
        ridge[-1, -1] = 1e-9
        solved.append(np.linalg.solve(features.T @ scaled + ridge, scaled.T @ labels[:, place]))
    solution = np.array(solved).T
    weights = np.r_[root @ solution[:-1], solution[-1:]]
    return Model(languages, landmarks, weights.astype(np.float32))


def identify(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    ``und`` with score 0 where the text is null or has no letter. A null id is never held out. Every
    row stands for itself; further columns are ignored. The model (a few MB, bounded by the sample) is
    broadcast.
    """
    model = model or fit(documents)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = learned.predict(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()),
                        batch.column("held_out"),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = documents.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"
    )
    return rows.mapInArrow(work, SCHEMA)


def identified(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with a language: all columns, without those that the model rejects."""
    model = model or fit(documents)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = learned.predict(batch.column(place).to_pylist())
                keep = [lang != UNDETERMINED and score >= REJECT_BELOW for lang, score in found]
                yield batch.filter(pa.array(keep, pa.bool_()))
        tidy()

    return documents.mapInArrow(work, documents.schema)
