from tableferry.operators.messages import purge_counts, select_purgeable

PHRASES = ["Nightly copy", "Test message"]
TEXTS = {
    "start": "Test message: hello",
    "ends_at_50": "x" * 38 + "Test message" + " and on",
    "straddles_50": "x" * 39 + "Test message",
    "after_50": "x" * 60 + "Test message",
    "second_phrase": "see Nightly copy",
    "other_case": "test message",
    "none": None,
    "empty": "",
    "wide": "漢" * 38 + "Test message",
    "astral": "😀" * 38 + "Test message",
}
CHOSEN = {"start", "ends_at_50", "second_phrase", "wide", "astral"}


def messages(spark):
    return spark.createDataFrame(list(TEXTS.items()), "ts string, text string")


def test_selection(spark):
    assert {r.ts for r in select_purgeable(messages(spark), PHRASES).collect()} == CHOSEN
    brute = {k for k, v in TEXTS.items() if any(p in (v or "")[:50] for p in PHRASES)}
    assert brute == CHOSEN


def test_counts(spark):
    assert tuple(purge_counts(messages(spark), PHRASES).first()) == (len(TEXTS), len(CHOSEN))


def test_no_phrase_selects_nothing(spark):
    assert select_purgeable(messages(spark), []).count() == 0
