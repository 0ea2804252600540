"""Quality rules as a ledger of failure bits and measurements, on built-in functions only.

Every rule is evaluated once per document and leaves one bit. Policies are versioned masks over
those bits: applying one, changing one, or asking what each rule alone removes reads the ledger and
never the texts again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that parts words: space, tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A document fails where ``condition`` (SQL over the measurements) holds."""

    name: str
    condition: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("very_many_words", "n_words > 1000000"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("symbols", "2 * n_symbols > n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("some_repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("some_symbols", "10 * n_symbols > n_words"),
)
BASE = ("few_words", "repeated_words")
#: Rules of each version of the verdict, beside the base rules.
POLICIES = {
    "v1": (*BASE, "very_many_words", "short_words", "long_words", "symbols", "duplicate_lines"),
    "strict": tuple(rule.name for rule in RULES),
}


def mask(names: tuple[str, ...]) -> int:
    places = {rule.name: place for place, rule in enumerate(RULES)}
    return sum(1 << places[name] for name in names)


def measure(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements; a null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Words go on as longs; their strings are taken again only where a window may be repeated.
    split = documents.select(
        F.col("doc_id"),
        text.alias("text"),
        F.transform(
            F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda word: F.xxhash64(word)
        ).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)).alias("lines"),
    )
    counted = split.select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("length(bin(size(words)))").alias("place_bits"),
        F.expr(
            """
            CASE WHEN size(words) < 3 THEN cast(array() AS array<bigint>) ELSE
              transform(sequence(0, size(words) - 3), i ->
                xxhash64(words[i], words[i + 1], words[i + 2]))
            END
            """
        ).alias("hashes"),
    )
    # Most texts repeat no window and end here. In the others, one long per window holds its hash
    # above its place, so that equal hashes are neighbours when sorted.
    windows = counted.withColumn(
        "windows",
        F.expr(
            """
            CASE WHEN size(array_distinct(hashes)) = size(hashes) THEN cast(array() AS array<bigint>)
            ELSE sort_array(transform(hashes, (h, i) ->
              shiftleft(h, place_bits) | cast(i AS bigint)))
            END
            """
        ),
    )
    # Of neighbours with one hash, those whose words are equal, too.
    pairs = windows.withColumn(
        "pairs",
        F.expr(
            """
            filter(sequence(1, greatest(size(windows) - 1, 1)), k ->
              k < size(windows)
              AND shiftright(windows[k], place_bits) = shiftright(windows[k - 1], place_bits)
            )
            """
        ),
    )
    places = pairs.withColumn(
        "words",
        F.when(
            F.size("pairs") > 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
        ),
    ).withColumn(
        "places",
        F.expr(
            """
            flatten(transform(pairs, k -> array(
              cast(windows[k] & (shiftleft(1L, place_bits) - 1) AS int),
              cast(windows[k - 1] & (shiftleft(1L, place_bits) - 1) AS int))))
            """
        ),
    )
    proven = F.expr(
        """
        flatten(transform(sequence(0, greatest(size(places) DIV 2 - 1, 0)), j ->
          CASE WHEN 2 * j + 1 < size(places)
                AND words[places[2 * j]] = words[places[2 * j + 1]]
                AND words[places[2 * j] + 1] = words[places[2 * j + 1] + 1]
                AND words[places[2 * j] + 2] = words[places[2 * j + 1] + 2]
          THEN array(places[2 * j], places[2 * j + 1]) ELSE cast(array() AS array<int>) END))
        """
    )
    covered = F.expr(
        """
        CASE WHEN size(pairs) = 0 THEN 0L ELSE cast(size(array_distinct(concat(
          proven, transform(proven, p -> p + 1), transform(proven, p -> p + 2)))) AS bigint) END
        """
    )
    return places.withColumn("proven", proven).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        covered.alias("n_repeat_words"),
    )


def ledger(documents: DataFrame) -> DataFrame:
    """Measurements and ``failed_bits`` (bit n for rule n) of every document; map-only.

    A null or empty text has no words, lines or symbols and fails ``few_words``. Every row stands for
    itself, null and repeated ids too; further columns are ignored.
    """
    bits = " | ".join(
        f"(CASE WHEN {rule.condition} THEN {1 << place}L ELSE 0L END)"
        for place, rule in enumerate(RULES)
    )
    return measure(documents).withColumn("failed_bits", F.expr(bits))


def apply_policy(entries: DataFrame, policy: str) -> DataFrame:
    """Adds ``base_failed`` and ``kept``: no base rule and no rule of the policy failed."""
    base_failed = F.col("failed_bits").bitwiseAND(F.lit(mask(BASE))) != 0
    rejected = F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[policy]) | mask(BASE))) != 0
    return entries.withColumn("base_failed", base_failed).withColumn("kept", ~rejected)


def ablations(entries: DataFrame) -> DataFrame:
    """What each rule of each policy does: ``policy, rule, n_failed, n_only, n_kept_without``.

    Documents are first counted by their bits, so what is left does not grow with the corpus.
    """
    patterns = entries.groupBy("failed_bits").agg(F.count("*").alias("n"))
    cases = F.array(
        *(
            F.struct(
                F.lit(policy).alias("policy"),
                F.lit(name).alias("rule"),
                F.lit(mask(names)).cast("long").alias("mask"),
                F.lit(mask((name,))).cast("long").alias("bit"),
            )
            for policy, names in POLICIES.items()
            for name in names
        )
    )
    rows = patterns.select("failed_bits", "n", F.explode(cases).alias("case")).select(
        "failed_bits", "n", "case.*"
    )
    of_policy = F.col("failed_bits").bitwiseAND(F.col("mask"))
    others = of_policy.bitwiseAND(F.bitwise_not("bit"))
    failed = of_policy.bitwiseAND(F.col("bit")) != 0

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    return rows.groupBy("policy", "rule").agg(
        total(failed).alias("n_failed"),
        total(failed & (others == 0)).alias("n_only"),
        total(others == 0).alias("n_kept_without"),
    )


def quality(documents: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with the verdict of a policy."""
    return apply_policy(ledger(documents), policy).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "failed_bits",
    )
