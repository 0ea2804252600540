"""Token counts by rank-synchronous array merging of byte-level BPE.

A batch of pre-tokens is one flat array of symbols with the number of the pre-token beside each. A
round finds every pre-token's lowest-ranked adjacent pair, merges all its places in all pre-tokens at
once, and drops the pre-tokens that have no pair left. What survives is counted.

Texts are cut before a single space between two non-space characters, where the pre-tokenizer's
pattern always ends a pre-token, and each worker remembers the counts of the pieces it has seen.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tableferry.llm.common import Remembered, no_collection, slices

#: Pattern of the byte-level pre-tokenizer: a fixed value of the format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAFE_CUT = regex.compile(r"(?<=\S)(?= \S)", regex.V1)
#: Characters of text that a worker splits at a time.
SLICE_CHARS = 2_000_000
NO_PAIR = np.int64(1) << 40

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {byte: chr(byte) for byte in shown} | {
        byte: chr(256 + place) for place, byte in enumerate(hidden)
    }


class MergeRanks:
    """The merge list as sorted arrays."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        self.bits = max(1, int(max(vocabulary.values())).bit_length())
        keys = (left << self.bits) | right
        # A pair listed twice keeps its later rank, as in a mapping filled in order.
        ranks = np.arange(len(pairs), dtype=np.int64)
        order = np.lexsort((-ranks, keys))
        first = np.ones(len(order), dtype=bool)
        first[1:] = keys[order][1:] != keys[order][:-1]
        order = order[first]
        self.keys, self.ranks, self.made = keys[order], ranks[order], made
        born = np.full(1 << self.bits, -1, dtype=np.int64)
        born[made[::-1]] = ranks[::-1]
        # Where each merge needs only symbols of earlier merges, all places of a pair merge at once.
        if len(pairs) and (np.maximum(born[left], born[right]) >= ranks).any():
            raise ValueError("a merge needs a symbol that a later merge makes")
        characters = byte_characters()
        self.of_byte = np.array([vocabulary[characters[b]] for b in range(256)], dtype=np.int64)
        # Every word begins as bytes, so its first ranks come from a table of byte pairs.
        grid = np.repeat(self.of_byte, 256), np.tile(self.of_byte, 256)
        self.of_bytes = self.find(*grid)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NO_PAIR)
        wanted = (left << self.bits) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_PAIR)

    def surviving(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols that each word ends with."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        counts = np.zeros(len(words), dtype=np.int64)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.of_byte[raw]
        owner = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(raw), NO_PAIR)
        if len(raw) > 1:
            pairs = self.of_bytes[(raw[:-1].astype(np.int64) << 8) | raw[1:]]
            rank[:-1] = np.where(owner[1:] == owner[:-1], pairs, NO_PAIR)
        while len(symbols):
            places = np.flatnonzero(rank < NO_PAIR)
            busy = np.zeros(len(words), dtype=bool)
            busy[owner[places]] = True
            stays = busy[owner]
            if not stays.all():  # finished words are counted and leave the arrays
                counts += np.bincount(owner[~stays], minlength=len(words))
                symbols, owner, rank = symbols[stays], owner[stays], rank[stays]
                places = np.flatnonzero(rank < NO_PAIR)
            if not len(places):
                break
            of, found = owner[places], rank[places]
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            lowest = np.minimum.reduceat(found, starts)
            lowest = np.repeat(lowest, np.diff(np.r_[starts, len(of)]))
            places = places[found == lowest]
            # Of overlapping places of a pair (as in a a a) the first, third, ... count.
            new_run = np.r_[True, np.diff(places) != 1]
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run_start) % 2 == 0]
            symbols[places] = self.made[rank[places]]
            stays = np.ones(len(symbols), dtype=bool)
            stays[places + 1] = False
            symbols, owner = symbols[stays], owner[stays]
            rank = self._ranks(symbols, owner)
        return counts

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each place."""
        rank = np.full(len(symbols), NO_PAIR)
        if len(symbols) > 1:
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inside] = self.find(symbols[inside], symbols[inside + 1])
        return rank


class TokenCounter:
    """Counts tokens of texts; remembers pieces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = (
            model["type"] == "BPE"
            and pre["type"] == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre["add_prefix_space"]
            and spec.get("normalizer") is None
            and not model.get("ignore_merges")
        )
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        added = [t for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: added tokens that take in their surroundings")
        self.special = [t["content"] for t in added]
        self.special_cut = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.pattern = regex.compile(PATTERN)
        self.merges = MergeRanks(model["vocab"], model["merges"])
        self.after_space = Remembered()  # by the piece without its space
        self.literal = Remembered()

    @no_collection()
    def counts(self, texts: list[str]) -> list[int]:
        spaced: list[list[str]] = []
        literal: list[list[str]] = []
        extra: list[int] = []
        for text in texts:
            parts = [text]
            if any(mark in text for mark in self.special):
                parts = self.special_cut.split(text)
            extra.append(len(parts) - 1)
            plain, rest = [], []
            for part in parts:
                head, *tail = part.split(" ")
                new = set(tail).difference(self.after_space.young)
                if safe(head) and all(map(safe, new)):
                    rest.append(head)
                    plain += tail
                elif part:
                    rest += SAFE_CUT.split(part)
            spaced.append(plain)
            literal.append(rest)
        self._learn(self.after_space.missing(map(set, spaced)), self.after_space.young, " ")
        self._learn(self.literal.missing(map(set, literal)), self.literal.young, "")
        after, alone = self.after_space.young.__getitem__, self.literal.young.__getitem__
        return [
            sum(map(after, a)) + sum(map(alone, b)) + c
            for a, b, c in zip(spaced, literal, extra, strict=True)
        ]

    def _learn(self, new: set[str], known: dict[str, int], prefix: str) -> None:
        if not new:
            return
        words: dict[str, int] = {}
        uses = [
            [words.setdefault(w, len(words)) for w in self.pattern.findall(prefix + piece)]
            for piece in new
        ]
        counts = self.merges.surviving([word.encode("utf-8") for word in words])
        flat = np.fromiter((w for use in uses for w in use), dtype=np.int64)
        ends = np.cumsum([len(use) for use in uses])
        total = np.r_[0, np.cumsum(counts[flat])]
        begins = np.r_[0, ends[:-1]]
        known.update(zip(new, (total[ends] - total[begins]).tolist(), strict=True))


def safe(piece: str) -> bool:
    """Whether the cuts beside a piece between two spaces end pre-tokens."""
    return piece != "" and not piece[0].isspace() and not piece[-1].isspace()


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter for each worker and vocabulary."""
    return TokenCounter(path)


def count_tokens(documents: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """Tokens of every document: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``vocabulary`` is a tokenizer file that every executor has. A null or empty text has no bytes and
    no tokens. Special strings inside a text are one token each. Repeated rows and null ids are kept,
    each row on its own; further columns are ignored. Map-only.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(vocabulary)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for texts in slices(batch.column("text").to_pylist(), SLICE_CHARS):
                n_bytes += [len(text.encode("utf-8")) for text in texts]
                n_tokens += tokens.counts(texts)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_bytes": pa.array(n_bytes, pa.int64()),
                    "n_tokens": pa.array(n_tokens, pa.int64()),
                    "over_limit": pa.array([n > limit for n in n_tokens], pa.bool_()),
                }
            )

    return documents.select("doc_id", "text").mapInArrow(work, SCHEMA)
