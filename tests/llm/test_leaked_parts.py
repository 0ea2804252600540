"""Short items and passages of long ones, against a search without any filter."""

import random
import re

from tableferry.llm import decontaminate


def words(draw: random.Random, count: int) -> str:
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(3, 8))) for _ in range(count))


def longest_run(a: str, b: str) -> int:
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0, *(row[i] + 1 if x == y else 0 for i, y in enumerate(b))]
        best = max(best, *row)
    return best


def test_short_items_and_passages_equal_the_unfiltered_search(spark):
    draw = random.Random(11)
    short, brief, long, huge = words(draw, 5)[:30].strip(), "q", words(draw, 40), words(draw, 400)
    middle = " ".join(huge.split()[150:202])  # 52 words, an eighth of the item
    items = [(1, short), (2, brief), (3, long), (4, huge), (5, short.upper()), (6, " ")]
    around = [words(draw, 30) for _ in range(8)]
    texts = [
        f"{around[0]} {short}, {around[1]}",
        f"{around[2]} x{short}x {around[3]}",  # not as words
        f"{around[4]} {long[: len(long) // 2 + 1]}",
        f"{long[len(long) // 2 - 1 :]} {around[5]}",
        f"{around[6]} {middle} {around[7]}",
        f"{around[0]} {long[: len(long) // 3]}",  # a third is no leak
        "a Q a",
        long + " " + short,
    ]
    wanted = set()
    for doc_id, text in enumerate(texts):
        text = " ".join(text.lower().split())
        for item_id, item in items:
            item = " ".join(item.lower().split())
            if not item:
                continue
            if len(item) < decontaminate.MIN_CHARS:
                leak = re.search(rf"(?<!\w){re.escape(item)}(?!\w)", text)
            else:
                least = decontaminate.passage_of(decontaminate.codes_of(item))
                leak = longest_run(item, text) >= least
            if leak:
                wanted.add((doc_id, item_id))
    assert {(0, 1), (2, 3), (3, 3), (4, 4), (6, 2), (7, 1), (7, 5)} <= wanted
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.leaks(documents, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == wanted and len(rows) == len(wanted)
    kept = decontaminate.decontaminate(documents, benchmark).collect()
    assert sorted(r.doc_id for r in kept) == [1, 5]
