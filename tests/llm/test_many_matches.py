"""Texts with very many matches: the same places as one by one, in a time that grows with the text."""

import random
import re
import time

from tableferry.llm import licenses, secret_scan
from tableferry.llm.common import table
from tableferry.llm.licenses import Detection, suppress

ACCESS = re.compile("AKIA[A-Z0-9]+")


def test_places_of_many_secrets(spark):
    model = secret_scan.train(table(spark, "/root/testdata/sf0.001", "documents"))
    rng = random.Random(3)
    texts = [
        " ".join("é" * rng.randint(0, 3) + f" AKIA{i:012d}" + "x" * rng.randint(0, 2) for i in range(n))
        for n in (0, 1, 255, 256, 257, 512, 40_000)
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in secret_scan.find_spans(frame, model).collect():
        found = [(s.start, s.stop) for s in row.base if s.kind == "access"]
        assert found == [m.span() for m in ACCESS.finditer(texts[row.doc_id])]


def test_suppression_against_all_pairs():
    def all_pairs(found):
        kept = []
        for one in sorted(found, key=lambda d: (d.priority, d.first, -d.last, d.rule)):
            if not any(k.first <= one.first and one.last <= k.last for k in kept):
                kept.append(one)
        return sorted(kept, key=lambda d: (d.first, d.last, d.rule))

    rng = random.Random(4)
    for _ in range(2000):
        found = []
        for rule in range(rng.randint(0, 12)):
            first = rng.randint(0, 8)
            priority = rng.randint(0, 2)
            found.append(Detection(f"l{rule % 3}", rule, first, first + rng.randint(0, 5), priority))
        assert suppress(found) == all_pairs(found)


def test_many_licences_take_linear_time():
    unit = "the mit license and the apache license here "
    seconds = []
    for size in (500_000, 2_000_000):
        start = time.perf_counter()
        row = licenses._row(licenses.scanner(), unit * (size // len(unit)))
        seconds.append(time.perf_counter() - start)
        assert row[1] == 2 * (size // len(unit))
    assert seconds[1] < 10 * seconds[0] + 1
