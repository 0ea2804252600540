"""Secret scan: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two chains over pairs of neighbouring characters are counted from labelled samples: values that the
patterns mark and digests of ids (random strings), and words of texts with names made of them
(ordinary identifiers). A run of key characters whose log-likelihood ratio is high enough is a span of
its own. All of it is built-in functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Patterns of the base kinds; letters of ``ASSIGN`` stand in either case.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
#: Matches of ``[0-9a-f]+`` are whole runs, so asking for the length here finds the same long ones.
HEX = rf"[0-9a-f]{{{MIN_HEX},}}"
#: One of them is in every text with a match of ``ASSIGN``, in lower case.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: What the models look at: runs of key characters of some length, with a letter.
RUN = r"[A-Za-z0-9+/_=-]{16,}"
#: Key characters lie between the codes of "+" and "z".
FIRST, CODES = 0x2B, 0x7B - 0x2B
KEY_CHARACTERS = 66
#: About so many documents (chosen by a hash of id and text) give the labelled samples.
SAMPLE_DOCUMENTS = 400
SMOOTHING = 0.5
#: The ratio that a run needs, in thousandths of a natural logarithm.
THRESHOLD = 12_000
MASK = "[SECRET]"

KINDS = ("assign", "access", "hex", "markov")
SPANS = "array<struct<start:bigint,kind_order:int,kind:string,stop:bigint>>"
LOCATED = "array<struct<start:bigint,stop:bigint,value:string>>"
#: Matches whose places are added up in one go.
BLOCK = 256
BLOCKS = (
    "array<struct<place:bigint,block:array<struct<before:bigint,size:bigint,value:string>>>>"
)


def quoted(pattern: str) -> str:
    """A SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class MarkovModel:
    """Of each pair of codes, the log-likelihood ratio of random over ordinary in thousandths."""

    ratios: tuple[int, ...]

    def score(self, value: str) -> str:
        """SQL for the ratio of a string of key characters, summed over its pairs."""
        table = f"cast(split('{','.join(map(str, self.ratios))}', ',') AS array<int>)"
        code = f"(ascii(substring({value}, {{}}, 1)) - {FIRST})"
        return (
            f"aggregate(sequence(1, length({value}) - 1), 0L, (total, i) -> total + "
            f"{table}[{code.format('i')} * {CODES} + {code.format('i + 1')}])"
        )


def samples(documents: DataFrame) -> DataFrame:
    """Labelled strings: ``value, random`` from a bounded choice of documents, by a hash of id and text."""
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, documents.count()))
    chosen = documents.where(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(share * 1_000_000)
    ).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    random = chosen.select(
        F.explode(
            F.expr(
                f"""
                concat(
                  filter(regexp_extract_all(text, {quoted(ASSIGN)}, 2),
                         v -> length(v) >= {MIN_ASSIGN}),
                  regexp_extract_all(text, 'AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}', 0),
                  array(sha2(doc_id, 256),
                        base64(unhex(sha2(concat('a', doc_id), 256))),
                        base64(unhex(sha2(concat('b', doc_id), 512))),
                        lower(base64(unhex(sha2(concat('c', doc_id), 256)))),
                        upper(base64(unhex(sha2(concat('d', doc_id), 256))))))
                """
            )
        ).alias("value"),
        F.lit(True).alias("random"),
    )
    words = chosen.select(
        F.explode(
            F.expr(
                f"""
                regexp_extract_all(
                  regexp_replace(regexp_replace(text, {quoted(ASSIGN)}, ' '),
                                 {quoted(HEX)}, ' '),
                  '[A-Za-z]+', 0)
                """
            )
        ).alias("word")
    )
    # One word of four becomes a name, so that joints, capitals and digits occur.
    ordinary = words.select(
        F.expr(
            """
            CASE pmod(xxhash64(word), 32)
              WHEN 0 THEN concat(word, '_', word)
              WHEN 1 THEN concat(word, '-', word)
              WHEN 2 THEN concat(word, '/', word)
              WHEN 3 THEN concat(word, '=', word)
              WHEN 4 THEN concat(word, initcap(word), initcap(word))
              WHEN 5 THEN concat(word, cast(length(word) % 10 AS string))
              WHEN 6 THEN concat('2', word, '0', length(word))
              WHEN 7 THEN upper(word)
              ELSE word END
            """
        ).alias("value"),
        F.lit(False).alias("random"),
    )
    return random.unionByName(ordinary)


def train(documents: DataFrame) -> MarkovModel:
    """Count pairs of characters in the labelled samples; at most one row per pair and label."""
    pairs = samples(documents).select(
        "random",
        F.explode(
            F.expr("transform(sequence(1, greatest(length(value) - 1, 1)), i -> substring(value, i, 2))")
        ).alias("pair"),
    )
    counts = pairs.groupBy("random", "pair").count().collect()
    seen: dict[tuple[bool, str], int] = {
        (r["random"], r["pair"]): r["count"]
        for r in counts
        if len(r["pair"]) == 2 and FIRST <= min(map(ord, r["pair"]))
    }
    after: dict[tuple[bool, str], int] = {}
    for (label, pair), count in seen.items():
        after[label, pair[0]] = after.get((label, pair[0]), 0) + count

    def logarithm(label: bool, pair: str) -> float:
        total = after.get((label, pair[0]), 0) + SMOOTHING * KEY_CHARACTERS
        return math.log((seen.get((label, pair), 0) + SMOOTHING) / total)

    characters = [chr(FIRST + code) for code in range(CODES)]
    return MarkovModel(
        tuple(
            round(1000 * (logarithm(True, a + b) - logarithm(False, a + b)))
            for a in characters
            for b in characters
        )
    )


def located(matches: str, between: str, values: str) -> str:
    """SQL: start, stop (code points) and value of each match.

    ``between`` holds what lies before, between and behind the matches. No column is named inside a
    lambda: the optimizer would put its expression there, to be worked out for each element. Places are
    added up for blocks of matches first, then inside each, as adding to a list copies it.
    """
    pairs = f"""
        transform(
          filter(cast(arrays_zip({matches}, {between}, {values})
                      AS array<struct<m:string,b:string,v:string>>), z -> z.m IS NOT NULL),
          z -> named_struct(
            'before', cast(length(z.b) AS bigint),
            'size', cast(length(z.m) AS bigint),
            'value', z.v))
    """
    blocks = f"""
        flatten(transform(array({pairs}), a -> transform(
          sequence(0, size(a), {BLOCK}), k -> slice(a, k + 1, {BLOCK}))))
    """
    return f"""
        flatten(transform(
          aggregate(
            {blocks},
            named_struct('place', 0L, 'out', cast(array() AS {BLOCKS})),
            (s, b) -> named_struct(
              'place', s.place + aggregate(b, 0L, (n, p) -> n + p.before + p.size),
              'out', concat(s.out, array(named_struct('place', s.place, 'block', b)))),
            s -> s.out),
          o -> aggregate(
            o.block,
            named_struct('place', o.place, 'out', cast(array() AS {LOCATED})),
            (s, p) -> named_struct(
              'place', s.place + p.before + p.size,
              'out', concat(s.out, array(named_struct(
                'start', s.place + p.before, 'stop', s.place + p.before + p.size,
                'value', p.value)))),
            s -> s.out)))
    """


def as_spans(column: str, kind: str, keep: str) -> str:
    """SQL: the spans of located matches ``x`` for which ``keep`` holds."""
    return f"""
        transform(filter({column}, x -> {keep}), x -> named_struct(
          'start', x.start, 'kind_order', {KINDS.index(kind)}, 'kind', '{kind}', 'stop', x.stop))
    """


def uncovered(base: str, own: str) -> str:
    """SQL: the spans of ``own`` that lie inside no span of ``base``.

    All spans by start: a span is covered if one of ``base`` up to it ends as late. The latest end is
    carried from block to block first, then inside each.
    """
    wide = f"""
        transform(array(array_sort(concat(
          transform({base}, b -> named_struct('start', b.start, 'own', 0, 'span', b)),
          transform({own}, b -> named_struct('start', b.start, 'own', 1, 'span', b))))),
          a -> transform(sequence(0, size(a), {BLOCK}), k -> slice(a, k + 1, {BLOCK})))
    """
    element = "struct<start:bigint,own:int,span:struct<start:bigint,kind_order:int,kind:string,stop:bigint>>"
    return f"""
        flatten(transform(
          aggregate(
            flatten(cast({wide} AS array<array<array<{element}>>>)),
            named_struct('last', -1L, 'out', cast(array() AS array<struct<last:bigint,block:array<{element}>>>)),
            (s, b) -> named_struct(
              'last', aggregate(b, s.last, (n, p) -> CASE WHEN p.own = 0 THEN greatest(n, p.span.stop) ELSE n END),
              'out', concat(s.out, array(named_struct('last', s.last, 'block', b)))),
            s -> s.out),
          o -> aggregate(
            o.block,
            named_struct('last', o.last, 'out', cast(array() AS {SPANS})),
            (s, p) -> named_struct(
              'last', CASE WHEN p.own = 0 THEN greatest(s.last, p.span.stop) ELSE s.last END,
              'out', CASE WHEN p.own = 1 AND p.span.stop > s.last
                          THEN concat(s.out, array(p.span)) ELSE s.out END),
            s -> s.out)))
    """


def find_spans(documents: DataFrame, model: MarkovModel) -> DataFrame:
    """``doc_id, text, base, spans``: the spans of every text, sorted; map-only.

    A null text is taken as empty and has no spans. Every row stands for itself.
    """
    # Gates come first, each once: most texts pass none, and their patterns never run.
    lowered = documents.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.lower(F.coalesce("text", F.lit(""))).alias("lowered"),
    )
    keywords = " OR ".join(f"contains(lowered, '{word}')" for word in KEYWORDS)
    frame = lowered.select(
        "doc_id",
        "text",
        F.expr(keywords).alias("may_assign"),
        F.expr("contains(text, 'AKIA')").alias("may_access"),
        F.col("text").rlike(HEX).alias("may_hex"),
    )
    empty = "cast(array() AS array<string>)"

    def when(condition: str, value: str) -> str:
        return f"CASE WHEN {condition} THEN {value} ELSE {empty} END"

    columns = {}
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        gate = f"may_{kind}"
        columns[f"{kind}_matches"] = when(gate, f"regexp_extract_all(text, {quoted(pattern)}, 0)")
        columns[f"{kind}_between"] = when(gate, f"split(text, {quoted(pattern)}, -1)")
    columns["assign_values"] = when("may_assign", f"regexp_extract_all(text, {quoted(ASSIGN)}, 2)")
    columns["likely"] = f"""
        transform(regexp_extract_all(text, {quoted(RUN)}, 0), run -> cast(
          run RLIKE '[A-Za-z]' AND {model.score('run')} >= {THRESHOLD} AS string))
    """
    frame = frame.select("doc_id", "text", *(F.expr(v).alias(k) for k, v in columns.items()))
    # Places of runs are worked out only in texts that hold a likely one.
    runs = {
        "run_matches": when("array_contains(likely, 'true')", f"regexp_extract_all(text, {quoted(RUN)}, 0)"),
        "run_between": when("array_contains(likely, 'true')", f"split(text, {quoted(RUN)}, -1)"),
    }
    frame = frame.select("*", *(F.expr(v).alias(k) for k, v in runs.items()))
    frame = frame.select(
        "doc_id",
        "text",
        F.expr(located("assign_matches", "assign_between", "assign_values")).alias("assign"),
        F.expr(located("access_matches", "access_between", "access_matches")).alias("access"),
        F.expr(located("hex_matches", "hex_between", "hex_matches")).alias("hex"),
        F.expr(located("run_matches", "run_between", "likely")).alias("runs"),
    )
    least = {"assign": MIN_ASSIGN, "access": MIN_ACCESS, "hex": MIN_HEX}
    base = ", ".join(as_spans(k, k, f"length(x.value) >= {n}") for k, n in least.items())
    frame = frame.select(
        "doc_id",
        "text",
        "runs",
        F.expr(f"cast(array_sort(concat({base})) AS {SPANS})").alias("base"),
    )
    own = f"cast({as_spans('runs', 'markov', "x.value = 'true'")} AS {SPANS})"
    frame = frame.select("doc_id", "text", "base", F.expr(own).alias("own"))
    return frame.select(
        "doc_id",
        "text",
        "base",
        F.expr(f"cast(array_sort(concat(base, {uncovered('base', 'own')})) AS {SPANS})").alias("spans"),
    )


def joined(column: str) -> str:
    return (
        f"array_join(transform({column}, s -> concat_ws(':', s.kind, "
        "cast(s.start AS string), cast(s.stop AS string))), ',')"
    )


def scan(documents: DataFrame, model: MarkovModel | None = None) -> DataFrame:
    """Counts and spans of every document, with a model trained on them unless one is given."""

    def number(kind: str) -> str:
        return f"cast(size(filter(spans, s -> s.kind = '{kind}')) AS bigint)"

    return find_spans(documents, model or train(documents)).select(
        "doc_id",
        F.expr(number("assign")).alias("n_assign"),
        F.expr(number("access")).alias("n_access"),
        F.expr(number("hex")).alias("n_hex"),
        F.expr(f"sha2({joined('base')}, 256)").alias("base_sha256"),
        F.expr(joined("spans")).alias("spans"),
        F.expr(number("markov")).alias("n_markov"),
    )


def redact(documents: DataFrame, model: MarkovModel | None = None) -> DataFrame:
    """The documents with every span of their texts replaced by a mark; null texts stay null.

    Overlapping spans get one mark. Other columns are kept; ``n_chars``, if there, follows the text.
    """
    model = model or train(documents)
    # find_spans carries one column beside the text: here the whole row in place of the id.
    spans = find_spans(documents.select(F.struct("*").alias("doc_id"), "text"), model)
    text = f"""
        CASE WHEN doc_id.text IS NULL OR size(spans) = 0 THEN doc_id.text ELSE
          aggregate(spans, named_struct('place', 0L, 'out', ''),
            (s, p) -> CASE WHEN p.stop <= s.place THEN s ELSE named_struct(
              'place', p.stop,
              'out', concat(s.out, CASE WHEN p.start < s.place THEN '' ELSE concat(
                substring(text, cast(s.place + 1 AS int), cast(p.start - s.place AS int)),
                '{MASK}') END)) END,
            s -> concat(s.out, substring(text, cast(s.place + 1 AS int))))
        END
    """
    names = documents.columns
    out = spans.select(F.col("doc_id").alias("row"), F.expr(text).alias("masked"))
    size = F.length("masked").cast(dict(documents.dtypes).get("n_chars", "long"))
    replaced = {"text": F.col("masked"), "n_chars": size}
    return out.select(
        *(replaced[n].alias(n) if n in replaced else F.col("row")[n].alias(n) for n in names)
    )
