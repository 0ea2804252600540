"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

An edit of one code point changes the counts of a word's letters by a squared distance of one (a letter
more or less) or two (one letter for another). Words are dealt into cells by how many letters of each of
a few classes they hold, which fixes their length; one edit leads to the same cell or to one of
a few next to it, of the same or an adjacent length. Each cell is a block, or several of about
:data:`BLOCK` words, and meets the words of half of the cells around it, so that any two cells meet once.
There the products of count matrices give all squared distances, pairs at most two apart stay, and their
edits are verified letter by letter. A block keeps only sums and the best near word of each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import written

#: A run of letters, after A-Z are in lower case.
RUN = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many, by its hash, loses a letter.
DROP = 31
MIN_LENGTH, MIN_COUNT = 7, 2
#: A form occurs at least so many times as often as the word.
FORM_FACTOR = 10
#: Classes of letters that make a cell.
CLASSES = 5
#: Words of a block (about, they are dealt by a hash), and visitors compared with it in one go.
BLOCK, VISITORS = 2048, 4096
#: Cells that may be broadcast (a few dozen bytes each).
BROADCAST_CELLS = 1_000_000

FOUND = "word string, n_near long, best_n long, best_word string"


def words_of(documents: DataFrame) -> DataFrame:
    """``word, n``: words of the whole texts that are long and frequent enough."""
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= MIN_LENGTH)
    hashed = runs.select(
        "run", F.expr("crc32(cast(concat(doc_id, ':', run) AS binary))").alias("h")
    )
    dropped = "cast(h % length(run) AS int)"
    word = F.when(
        F.col("h") % DROP == 0,
        F.expr(f"concat(substring(run, 1, {dropped}), substring(run, {dropped} + 2))"),
    ).otherwise(F.col("run"))
    return (
        hashed.select(word.alias("word"))
        .where(F.length("word") >= MIN_LENGTH)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= MIN_COUNT)
    )


def letter_classes(words: DataFrame) -> list[str]:
    """The letters of all words in ``CLASSES`` classes of about equal share.

    Frequent letters are dealt first, there and back. Any classes give the same result; these give
    small cells.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    ranked = [r["letter"] for r in sorted(letters.collect(), key=lambda r: (-r["count"], r["letter"]))]
    classes = [""] * CLASSES
    for place, letter in enumerate(ranked):
        at = place % (2 * CLASSES)
        classes[min(at, 2 * CLASSES - 1 - at)] += letter
    return classes


def steps() -> list[tuple[int, ...]]:
    """From a cell to each next one, one of every two opposite steps: a letter more, or one for another."""
    more = [tuple(int(i == a) for i in range(CLASSES)) for a in range(CLASSES)]
    other = [
        tuple(int(i == a) - int(i == b) for i in range(CLASSES))
        for a, b in combinations(range(CLASSES), 2)
    ]
    return more + other


def dealt(words: DataFrame) -> DataFrame:
    """``cell, block, visitor, word, n``: words in their own block, and as visitors where they may have near words."""
    counts = [
        F.length("word") - F.length(F.translate("word", letters, ""))
        if letters
        else F.lit(0)
        for letters in letter_classes(words)
    ]
    celled = words.select("word", "n", F.array(*counts).alias("held"))
    cells = written(
        celled.groupBy(F.array_join("held", ",").alias("cell"))
        .agg(F.count("*").alias("size"))
        .select("cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")),
        "cells",
    )
    if cells.count() <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    moves = F.array(
        F.array_join("held", ","),
        *(
            F.concat_ws(",", *(F.col("held")[i] + step[i] for i in range(CLASSES)))
            for step in steps()
        ),
    )
    placed = celled.select("word", "n", F.posexplode(moves).alias("move", "cell")).join(cells, "cell")
    # A word is at home in one block of its cell, and visits the later ones.
    home = F.when(F.col("move") == 0, F.pmod(F.xxhash64("word"), "blocks").cast("int")).otherwise(0)
    return placed.select(
        "cell",
        "word",
        "n",
        "move",
        home.alias("home"),
        F.explode(F.sequence(home, F.col("blocks") - 1)).alias("block"),
    ).select(
        "cell", "block", (~((F.col("move") == 0) & (F.col("block") == F.col("home")))).alias("visitor"),
        "word", "n",
    )


class _Words:
    """Words of one length as a matrix of codes, with counts of letters."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        self.words = np.array(words, dtype=object)
        self.n = counts
        self.length = len(words[0])
        self.codes = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), self.length)

    def letters(self, kinds: np.ndarray, dtype: type) -> np.ndarray:
        place = np.zeros(256, dtype=np.int64)
        place[kinds] = np.arange(len(kinds))
        at = place[self.codes] + len(kinds) * np.arange(len(self.words))[:, None]
        counts = np.bincount(at.ravel(), minlength=len(self.words) * len(kinds))
        return counts.reshape(len(self.words), len(kinds)).astype(dtype)


def near_pairs(a: _Words, b: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of words exactly one edit apart; ``a`` is as long or one longer."""
    kinds = np.union1d(np.unique(a.codes), np.unique(b.codes))
    # Whole numbers in floating point, so they stay exact.
    dtype = np.float32 if a.length < 2048 else np.float64
    x, y = a.letters(kinds, dtype), b.letters(kinds, dtype)
    apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    left, right = np.nonzero(apart == (1 if a.length > b.length else 2))
    near = []
    some = max(1, (1 << 24) // a.length)
    for at in range(0, len(left), some):
        i, j = left[at : at + some], right[at : at + some]
        if a.length == b.length:
            near.append((a.codes[i] != b.codes[j]).sum(axis=1) == 1)
        else:
            long, short = a.codes[i], b.codes[j]
            front = np.cumprod(long[:, :-1] == short, axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
            back = np.cumprod((long[:, 1:] == short)[:, ::-1], axis=1, dtype=np.uint8)
            near.append(front + back.sum(axis=1, dtype=np.int64) >= b.length)
    keep = np.concatenate(near) if near else np.zeros(0, dtype=bool)
    return left[keep], right[keep]


def _sums(own: _Words, other: _Words, at: np.ndarray, near: np.ndarray) -> list[tuple]:
    """Of each word in ``own`` with near ones: it, how many, and the best of them."""
    if not len(at):
        return []
    order = np.lexsort((np.array(other.words[near], dtype=bytes), -other.n[near], at))
    at, near = at[order], near[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sizes = np.diff(np.r_[first, len(at)])
    return [
        (own.words[at[i]].decode("latin-1"), int(size), int(other.n[near[i]]), other.words[near[i]].decode("latin-1"))
        for i, size in zip(first.tolist(), sizes.tolist(), strict=True)
    ]


def _compare(own: _Words, others: list[tuple[bytes, int]]) -> list[tuple]:
    """The block's words against visitors, which may be of two lengths."""
    rows: list[tuple] = []
    for length in {len(word) for word, _ in others}:
        some = [(word, n) for word, n in others if len(word) == length]
        visitors = _Words([word for word, _ in some], np.array([n for _, n in some], dtype=np.int64))
        i, j = near_pairs(own, visitors)
        rows += _sums(own, visitors, i, j) + _sums(visitors, own, j, i)
    return rows


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, its own words first; visitors are compared as they come."""
    name, own = None, None
    home: list[tuple[bytes, int]] = []
    waiting: list[tuple[bytes, int]] = []
    rows: list[tuple] = []

    def settle() -> None:
        nonlocal own
        if own is None and home:
            own = _Words([w for w, _ in home], np.array([n for _, n in home], dtype=np.int64))
            i, j = near_pairs(own, own)
            rows.extend(_sums(own, own, i, j))
        if own is not None and waiting:
            rows.extend(_compare(own, waiting))
        waiting.clear()

    for batch in batches:
        for cell, block, visitor, word, n in zip(
            *(batch.column(c).to_pylist() for c in ("cell", "block", "visitor", "word", "n")), strict=True
        ):
            if (cell, block) != name:
                settle()
                name, own = (cell, block), None
                home.clear()
            (waiting if visitor else home).append((word.encode("latin-1"), n))
            if len(waiting) >= VISITORS:
                settle()
        if rows:
            yield _record(rows)
            rows.clear()
    settle()
    yield _record(rows)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["word", "n_near", "best_n", "best_word"],
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a form: forms followed to the last.

    A form is ten times as frequent as its word, so ways are short and never come back. Each round
    doubles how far a word sees; its state is a written table.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(state.join(further, "root", "left"), "roots")
        if joined.where("next IS NOT NULL").isEmpty():
            return state
        state = joined.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(documents: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word; see the contract of ``op13``.

    A null text has no words. A null id counts as an empty one in the hash. Every row stands for itself;
    further columns are ignored. Words of any length take part, and a word without near ones is its
    own root.
    """
    words = written(words_of(documents), "words")
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = (
        dealt(words)
        .repartition(parts, "cell", "block")
        .sortWithinPartitions("cell", "block", "visitor")
        .mapInArrow(_blocks, FOUND)
    )
    best = F.struct((-F.col("best_n")).alias("less"), F.col("best_word").alias("word"))
    summed = (
        words.select(
            "word", "n", F.lit(0).cast("long").alias("n_near"),
            F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best_word"),
        )
        .unionByName(near.withColumn("n", F.lit(None).cast("long")))
        .groupBy("word")
        .agg(
            F.max("n").alias("n"),
            F.sum("n_near").alias("n_near"),
            F.min(F.when(F.col("best_n").isNotNull(), best)).alias("best"),
        )
    )
    is_form = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    found = written(
        summed.select(
            "word",
            "n",
            "n_near",
            F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    last = roots(found.where("form IS NOT NULL"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
