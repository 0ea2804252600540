"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

An item of n characters that stands in a text with at most k edits shares at least n - q + 1 - q k of
its q-grams with it, and the places of those q-grams lie within k diagonals of each other. Shared
q-grams are counted in overlapping bands of diagonals; bands that reach the bound are regions, and a
banded alignment of the item with the region decides.

A passage of an item is a leak, too, if it stands word for word: runs of neighbouring q-grams on one
diagonal are such passages, and those of at least :func:`passage_of` characters count. Items too short
for edits are looked for as they are, as whole words, by an automaton.

The items are cut into blocks of bounded size, each of which is broadcast and held against all
texts, so no bound on the number of items is needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import without, written

Q = 10
#: Edits allowed, per cent of the item's length.
EDITS = 8
#: Characters of items in a block: the bound of what is broadcast at once (some 40 bytes each).
BLOCK_CHARS = 1_000_000
#: Items shorter than this (in normal form) count without edits and as whole words; passages of longer
#: ones count from so many characters.
MIN_CHARS = 50
#: Words of an item's passage that are a leak, be they less than half of the item.
PASSAGE_WORDS = 50
FILTER_BITS = 22

SCHEMA = "doc_id long, item_id long, begin long, stop long, edits long"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normal_text(text: str) -> str:
    """The text in lower case, each run of white space as one space, none at the ends."""
    return " ".join(text.lower().split())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the q-gram at each place."""
    size = len(codes) - Q + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    # Doubling: hashes of 2, 4, 8 characters from two halves, and the rest from overlap.
    part, width = codes.astype(np.uint64), 1
    while width * 2 <= Q:
        part = part[:-width] * _BASE + part[width:]
        part ^= part >> np.uint64(29)
        width *= 2
    rest = Q - width
    return part[:size] * _BASE + part[rest : rest + size] if rest else part


@dataclass(frozen=True)
class Block:
    """Items and their q-grams: distinct hashes, and the occurrences of each in a row."""

    items: list[tuple[int | None, np.ndarray]]
    lengths: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray  # of each hash's occurrences, and the end of the last
    item: np.ndarray
    place: np.ndarray
    filter: np.ndarray  # a table that most q-grams of a text do not pass
    passages: np.ndarray  # characters of a passage that is a leak, for each item
    short: ahocorasick.Automaton | None  # short items, each with all its ids


def edits_of(length: int) -> int:
    return length * EDITS // 100


def bound_of(length: int) -> int:
    """q-grams that an occurrence within the edit budget shares at least."""
    return length - Q + 1 - Q * edits_of(length)


def passage_of(codes: np.ndarray) -> int:
    """Characters of the shortest passage that counts: half of the item, or so many of its words."""
    starts = np.r_[0, np.flatnonzero(codes == 0x20) + 1]
    ends = np.r_[starts[1:] - 1, len(codes)]
    half = -(-len(codes) // 2)
    if len(starts) > PASSAGE_WORDS:
        half = min(half, int((ends[PASSAGE_WORDS - 1 :] - starts[: 1 - PASSAGE_WORDS]).min()))
    return max(MIN_CHARS, half)


def block_of(items: list[tuple[int | None, str]]) -> Block:
    texts = [(item_id, normal_text(text)) for item_id, text in items]
    brief: dict[str, list[int | None]] = {}
    for item_id, text in texts:
        if 0 < len(text) < MIN_CHARS:
            brief.setdefault(text, []).append(item_id)
    short = None
    if brief:
        short = ahocorasick.Automaton()
        for text, ids in brief.items():
            short.add_word(text, (len(text), ids))
        short.make_automaton()
    codes = [(item_id, codes_of(text)) for item_id, text in texts if len(text) >= MIN_CHARS]
    hashes = [grams(c) for _, c in codes]
    empty = [np.zeros(0, dtype=np.uint64)]
    flat = np.concatenate(hashes or empty)
    item = np.repeat(np.arange(len(codes)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes] or [np.zeros(0, dtype=np.int64)])
    order = np.argsort(flat, kind="stable")
    table = np.zeros(1 << FILTER_BITS, dtype=bool)
    table[flat >> np.uint64(64 - FILTER_BITS)] = True
    hashes, starts = np.unique(flat[order], return_index=True)
    lengths = np.array([len(c) for _, c in codes], dtype=np.int64)
    return Block(
        codes,
        lengths,
        hashes,
        np.r_[starts, len(flat)],
        item[order],
        place[order].astype(np.int64),
        table,
        np.array([passage_of(c) for _, c in codes], dtype=np.int64),
        short,
    )


def shared_grams(codes: np.ndarray, block: Block) -> tuple[np.ndarray, ...] | None:
    """Item, place in the text and diagonal of every q-gram that the text shares with an item."""
    found = grams(codes)
    if not len(found) or not len(block.hashes):
        return None
    spots = np.flatnonzero(block.filter[found >> np.uint64(64 - FILTER_BITS)])
    wanted = found[spots]
    slot = np.minimum(np.searchsorted(block.hashes, wanted), len(block.hashes) - 1)
    real = block.hashes[slot] == wanted
    if not real.any():
        return None
    spots, slot = spots[real], slot[real]
    low = block.starts[slot]
    times = block.starts[slot + 1] - low
    at = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
    spots = np.repeat(spots, times)
    return block.item[at], spots, spots - block.place[at]


def passages(
    codes: np.ndarray, block: Block, shared: tuple[np.ndarray, ...]
) -> Iterator[tuple[int, int, int]]:
    """Item and range of the text of every passage that stands there word for word and is long enough."""
    item, spots, diagonal = shared
    often = np.bincount(item, minlength=len(block.lengths))
    worth = (often >= block.passages - Q + 1)[item]
    item, spots, diagonal = item[worth], spots[worth], diagonal[worth]
    if not len(item):
        return
    order = np.lexsort((spots, diagonal, item))
    item, spots, diagonal = item[order], spots[order], diagonal[order]
    new = np.r_[
        True, (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (spots[1:] != spots[:-1] + 1)
    ]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(item)]) + Q - 1
    for at in np.flatnonzero(sizes >= block.passages[item[starts]]).tolist():
        one, begin = int(item[starts[at]]), int(spots[starts[at]])
        stop, place = begin + int(sizes[at]), begin - int(diagonal[starts[at]])
        if np.array_equal(codes[begin:stop], block.items[one][1][place : place + stop - begin]):
            yield one, begin, stop


def regions(
    codes: np.ndarray, block: Block, shared: tuple[np.ndarray, ...]
) -> Iterator[tuple[int, int, int]]:
    """Item and range of the text of every band that reaches the item's bound."""
    item, _, diagonal = shared
    lengths = block.lengths
    budget = lengths * EDITS // 100
    # Bands start at multiples of their step (the budget and one) and are twice as wide, so any
    # budget + 1 neighbouring diagonals lie in one of them.
    step = budget[item] + 1
    own = diagonal // step
    bands = np.concatenate([own, own - 1])
    items = np.concatenate([item, item])
    order = np.lexsort((bands, items))
    bands, items = bands[order], items[order]
    new = np.r_[True, (bands[1:] != bands[:-1]) | (items[1:] != items[:-1])]
    starts = np.flatnonzero(new)
    counts = np.diff(np.r_[starts, len(bands)])
    least = lengths - Q + 1 - Q * budget
    for start in starts[counts >= least[items[starts]]].tolist():
        one = int(items[start])
        width = int(budget[one]) + 1
        begin = int(bands[start]) * width - width
        stop = int(bands[start]) * width + 3 * width + int(lengths[one])
        yield one, max(0, begin), min(len(codes), stop)


def verbatim(item: np.ndarray, text: np.ndarray) -> tuple[int, int] | None:
    """No edits and the end in ``text``, if the item stands there as it is."""
    raw, wanted = text.tobytes(), item.tobytes()
    at = raw.find(wanted)
    while at >= 0 and at % 4:
        at = raw.find(wanted, at + 1)
    return (0, at // 4 + len(item)) if at >= 0 else None


def aligned(item: np.ndarray, text: np.ndarray, budget: int) -> tuple[int, int] | None:
    """Fewest edits, and end in ``text``, of the whole item anywhere in it, within the budget.

    A row per character of the item over the region, which is a band of some budgets beside it.
    """
    size = len(text)
    steps = np.arange(size + 1)
    row = np.zeros(size + 1, dtype=np.int64)
    for place, code in enumerate(item.tolist()):
        new = np.empty_like(row)
        new[0] = place + 1
        new[1:] = np.minimum(row[:-1] + (text != code), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps  # insertions
        if row.min() > budget:
            return None
    end = int(row.argmin())
    return int(row[end]), end


def leaks_of(text: str, block: Block) -> list[tuple[int | None, int, int, int]]:
    """Item, begin, stop (of the region in the normal form) and edits of each leak, best per item.

    Of a passage, the rest of the item counts as edits.
    """
    text = normal_text(text)
    codes = codes_of(text)
    best: dict[int, tuple[int, int, int]] = {}
    shared = shared_grams(codes, block)
    for item, begin, stop in regions(codes, block, shared) if shared else ():
        _, own = block.items[item]
        if item in best and best[item][0] == 0:
            continue
        found = verbatim(own, codes[begin:stop]) or aligned(
            own, codes[begin:stop], edits_of(len(own))
        )
        if found and (item not in best or (found[0], begin) < best[item][:2]):
            best[item] = found[0], max(begin, begin + found[1] - len(own)), begin + found[1]
    for item, begin, stop in passages(codes, block, shared) if shared else ():
        rest = len(block.items[item][1]) - (stop - begin)
        if item not in best or (rest, begin) < best[item][:2]:
            best[item] = rest, begin, stop
    found = [(block.items[i][0], b, s, e) for i, (e, b, s) in sorted(best.items())]
    return found + short_leaks_of(text, block)


def short_leaks_of(text: str, block: Block) -> list[tuple[int | None, int, int, int]]:
    """The first place of each short item that stands in the text as whole words."""
    if block.short is None or not text:
        return []
    first: dict[str, tuple[list[int | None], int, int]] = {}
    for last, (size, ids) in block.short.iter(text):
        begin, stop = last + 1 - size, last + 1
        inside = (begin > 0 and text[begin - 1].isalnum() and text[begin].isalnum()) or (
            stop < len(text) and text[stop].isalnum() and text[last].isalnum()
        )
        if not inside:
            first.setdefault(text[begin:stop], (ids, begin, stop))
    return [(i, begin, stop, 0) for ids, begin, stop in first.values() for i in ids]


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of at most ``BLOCK_CHARS`` characters (a longer item is its own block)."""
    run, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL")
    for item_id, text in rows.orderBy("item_id", "text").toLocalIterator():
        if run and size + len(text) > BLOCK_CHARS:
            yield run
            run, size = [], 0
        run.append((item_id, text))
        size += len(text)
    if run:
        yield run


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, begin, stop, edits``: each item that stands in a document, once.

    ``begin`` and ``stop`` are places in the normal form of the text. Null and empty texts hold
    nothing and stand nowhere, items shorter than ``MIN_CHARS`` count word for word, repeated rows
    count each for itself and repeated items under each of their ids. Further columns are ignored. Map-only, once per block.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], SCHEMA)
    for items in blocks(benchmark):
        shared = spark.sparkContext.broadcast(block_of(items))
        out = out.unionByName(rows.mapInArrow(_finder(shared), SCHEMA))
    return out


def _finder(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            found = [
                (doc_id, *leak)
                for doc_id, text in zip(
                    batch.column("doc_id").to_pylist(), batch.column("text"), strict=True
                )
                for leak in leaks_of(text.as_py() or "", block)
            ]
            columns = zip(*found, strict=True) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=[part.split()[0] for part in SCHEMA.split(", ")],
            )

    return work


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold an item; all columns, nulls and repeats as they are."""
    found = written(leaks(documents, benchmark), "leaks")
    return without(documents, found.select("doc_id"))
