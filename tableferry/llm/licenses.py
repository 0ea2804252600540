"""License scan: ordered signature rules behind a keyword gate.

A rule is a regex over the normal form of a text (its words in lower case, single spaces between), with
a label and a priority. A text is only given the rules whose keywords it holds, found in one pass of
an automaton. Of overlapping detections, one that lies inside another of higher or equal priority is
suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tableferry.llm.license_rules import NAMES, PHRASES, SENTENCES

#: Bytes of the UTF-8 text that are no part of a word become spaces; A-Z become lower case.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 32
    for b in range(256)
)
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)
DETECTIONS = "doc_id long, label string, rule string, first_word long, last_word long"
#: Base phrases and their labels, as given.
BASE = PHRASES


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern[bytes]
    keywords: tuple[str, ...]  # every match holds one of them
    priority: int  # lower is stronger


def _form(text: str) -> str:
    """The normal form of a signature: a regex whose spaces are single and words whole."""
    return rf"(?<= )(?:{text})(?= )"


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order: sentences of licence texts, names behind a lead, identifiers, names."""
    leads = (
        "(?:dual |re)?licen[cs]ed under(?: the)?(?: terms of)?(?: the)?",
        "(?:released|distributed|available|published|provided) under(?: the)?(?: terms of)?(?: the)?",
        "under(?: the)? terms of(?: the)?",
        "subject to(?: the)?",
    )
    made: list[Rule] = []
    for label, keyword, pattern in SENTENCES:
        made.append(Rule(label, re.compile(_form(pattern).encode()), (keyword,), 0))
    for label, keyword, name, identifier in NAMES:
        key = tuple(keyword.split("|"))
        for lead in leads:
            made.append(Rule(label, re.compile(_form(f"{lead} {name}").encode()), key, 1))
        if identifier:
            spdx = f"spdx licen[cs]e identifier {identifier}"
            made.append(Rule(label, re.compile(_form(spdx).encode()), ("spdx",), 1))
        made.append(Rule(label, re.compile(_form(f"{name} licen[cs]e(?: agreement)?").encode()), key, 2))
        made.append(Rule(label, re.compile(_form(f"licen[cs]e {name}").encode()), key, 2))
    return tuple(made)


@dataclass(frozen=True)
class Detection:
    label: str
    rule: int
    first: int
    last: int
    priority: int


class Scanner:
    def __init__(self):
        self.rules = rules()
        self.base = [(b" " + phrase.encode() + b" ", label) for phrase, label in BASE]
        self.gate = ahocorasick.Automaton()
        by_keyword: dict[str, list[int]] = {}
        for place, rule in enumerate(self.rules):
            for keyword in rule.keywords:
                by_keyword.setdefault(keyword, []).append(place)
        for keyword, places in by_keyword.items():
            self.gate.add_word(keyword, places)
        self.gate.make_automaton()

    @staticmethod
    def normal(text: str) -> tuple[bytes, int]:
        """Normal form with a space at both ends, and the number of words."""
        words = text.encode("utf-8").translate(_WORD_BYTES).split()
        return b" " + b" ".join(words) + b" ", len(words)

    def base_places(self, form: bytes) -> list[tuple[int, str]]:
        """Start (in words) and label of every place of every base phrase."""
        found = []
        for phrase, label in self.base:
            word = Words(form)
            at = form.find(phrase)
            while at >= 0:
                found.append((word.before(at), label))
                at = form.find(phrase, at + 1)
        return found

    def detect(self, form: bytes) -> list[Detection]:
        """Detections of the gated rules that no other suppresses, in order of place."""
        gated = {r for _, places in self.gate.iter(form.decode("utf-8")) for r in places}
        found = []
        for place in sorted(gated):
            rule, word = self.rules[place], Words(form)
            for match in rule.pattern.finditer(form):
                first = word.before(match.start()) - 1
                last = first + match[0].count(b" ")
                found.append(Detection(rule.label, place, first, last, rule.priority))
        return suppress(found)


class Words:
    """Spaces before rising places of a text, each counted once."""

    def __init__(self, form: bytes):
        self.form, self.at, self.count = form, 0, 0

    def before(self, at: int) -> int:
        self.count += self.form.count(b" ", self.at, at)
        self.at = at
        return self.count


def suppress(found: list[Detection]) -> list[Detection]:
    """Drop detections inside another that is stronger, or as strong and wider (or earlier in order).

    A sweep by start, wide before narrow: what contains a detection comes before it or starts and ends
    with it, so for each priority the widest end so far tells whether something does.
    """
    kept: list[Detection] = []
    widest: dict[int, int] = {}
    for one in sorted(found, key=lambda d: (d.first, -d.last, d.priority, d.rule)):
        if all(end < one.last for priority, end in widest.items() if priority <= one.priority):
            kept.append(one)
        widest[one.priority] = max(one.last, widest.get(one.priority, one.last))
    return sorted(kept, key=lambda d: (d.first, d.last, d.rule))


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    """One scanner for each worker."""
    return Scanner()


def scan_licenses(documents: DataFrame) -> DataFrame:
    """Base phrases and detections of every document; map-only.

    ``score`` is the surest evidence: 1 for a sentence of a licence or an explicit grant, 0.75 for a
    name, 0.5 for a base phrase alone, 0 for none. A null text is taken as empty and has no words;
    every row stands for itself and further columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        for batch in batches:
            rows = [_row(scan, text.as_py() or "") for text in batch.column("text")]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(7)]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                ],
                names=[part.split()[0] for part in SCHEMA.split(", ")],
            )

    return documents.select("doc_id", "text").mapInArrow(work, SCHEMA)


def _row(scan: Scanner, text: str) -> tuple:
    form, n_words = scan.normal(text)
    base = scan.base_places(form)
    detections = scan.detect(form)
    starts = [start for start, _ in base]
    base_labels = {label for _, label in base}
    labels = base_labels | {d.label for d in detections}
    surest = min((d.priority for d in detections), default=3)
    score = {0: 1.0, 1: 1.0, 2: 0.75}.get(surest, 0.5 if base else 0.0)
    return (
        n_words,
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base_labels)),
        ",".join(sorted(labels)),
        score,
    )


def detections(documents: DataFrame) -> DataFrame:
    """One row per detection: ``doc_id, label, rule, first_word, last_word``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        for batch in batches:
            rows = [
                (doc_id, d.label, scan.rules[d.rule].pattern.pattern.decode(), d.first, d.last)
                for doc_id, text in zip(
                    batch.column("doc_id").to_pylist(), batch.column("text"), strict=True
                )
                for d in scan.detect(scan.normal(text.as_py() or "")[0])
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(5)]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[part.split()[0] for part in DETECTIONS.split(", ")],
            )

    return documents.select("doc_id", "text").mapInArrow(work, DETECTIONS)
