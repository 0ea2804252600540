"""Rows without an id, or with one id throughout, in what the models are trained on; caches of pieces."""

import pytest

from tableferry.llm import language, secret_scan
from tableferry.llm.common import Remembered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
IDS = {"none": lambda i: None, "some": lambda i: i if i % 3 else None, "one": lambda i: 11}


def frame(spark, ids, n=5000, texts=900):
    words = ["stone", "river", "maison", "rouge", "apple", "table", "jardin"]
    rows = []
    for i in range(n):
        text = " ".join(words[(i % texts * k) % 7] for k in range(1, 9)) + f" {i % texts}"
        rows.append((IDS[ids](i), text, ("en", "fr")[i % 2], "s", len(text)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("ids", list(IDS))
def test_language_sample_is_bounded(spark, ids):
    wanted = language.LANDMARKS + language.FIT_ROWS
    found = language.sample(frame(spark, ids))
    assert 0 < len(found) <= 2 * wanted
    same = frame(spark, ids, texts=1)
    assert len(language.sample(same)) <= 2 * wanted
    assert language.identify(same).count() == same.count()


@pytest.mark.parametrize("ids", list(IDS))
def test_secret_scan_trains_without_ids(spark, ids):
    rows = frame(spark, ids, 600)
    assert secret_scan.scan(rows).count() == 600
    assert secret_scan.redact(rows).count() == 600


def test_more_languages_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 1)
    rows = frame(spark, "some", 300).union(frame(spark, "some", 50).where("lang = 'fr'"))
    assert {r["lang"] for r in language.sample(rows)} == {"fr"}


def test_remembered_is_bounded_and_complete():
    kept = Remembered(limit=2000)
    for start in range(0, 400, 7):
        wanted = [{f"piece{i}" for i in range(start, start + 20)}, {"always"}, {f"{start}" * 900}]
        new = kept.missing(wanted)
        kept.young.update((piece, len(piece)) for piece in new)
        assert all(kept.young[piece] == len(piece) for pieces in wanted for piece in pieces)
        assert sum(map(len, {**kept.old, **kept.young})) < 12_000
        assert start == 0 or "always" not in new
