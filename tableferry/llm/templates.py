"""Main text of web pages by equivalence classes of tokens, which make the template of each host.

Tokens of a page are its tags (told apart by their path), the ends of its parts, and its text blocks
(told apart by path and words). The occurrence vector of a token says how often each different page of
the host has it; tokens of the same vector are an equivalence class. A class counts if enough pages have
it and enough tokens are in it, and is made valid: tokens that leave the order of their class on any
page go, and so does a class that crosses a more frequent one or lies in different gaps of the classes
around it. Valid classes nested into each other are the template of a host, the gaps between their
tokens its slots. The main text is what the slots hold inside the article, or, where no page part says
so, inside the frequent part with the most text in slots.

Pages count as one where their main text is the same, so that copies of an article do not make it a
template. A text inside an article is template only on hosts of four or more different pages that all
have it, and if all such texts together are less than half of the mean article: near copies keep
theirs. Headings of an article always stay.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import written

#: A class counts if this share of the host's different pages has it, at least so many of them, and if
#: it has so many tokens.
SUPPORT, MIN_PAGES, MIN_TOKENS = 0.6, 2, 3
#: Texts inside articles: on all of at least so many pages.
MIN_ARTICLES = 4
#: Templates that a task has at hand, each bounded by the size of a page.
REMEMBERED_HOSTS = 64
#: Templates of up to so many tokens (8 bytes each) over all hosts are broadcast.
BROADCAST_TOKENS = 1_000_000

TAG = re.compile(r"<(?:(/?)([a-z][a-z0-9:-]*)|(!--)|([!?/]))", re.I)
SPECIAL = re.compile(r"[>\"']")
#: Elements whose content is not markup; it is left out.
RAW = re.compile(r"(script|style|title|textarea|noscript|iframe|template|svg|math)\b", re.I)
RAW_END = {
    name: re.compile(rf"</{name}\s*>", re.I)
    for name in "script style title textarea noscript iframe template svg math".split()
}
ATTRIBUTE = re.compile(
    r"""(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I
)
#: Tags that make paths.
STRUCTURE = frozenset(
    "html head body header nav main article section aside footer div form ul ol dl table menu dialog "
    "fieldset details figure select button".split()
)
#: Further tags that end a block of text.
BREAKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption blockquote pre address figcaption hr legend "
    "summary option thead tbody tfoot hgroup center".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Parts that are never main text, by tag, by role, and by a class or id made of such words alone.
OUTSIDE_TAGS = frozenset("head nav aside footer form menu dialog select button fieldset".split())
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split()
)
OUTSIDE_WORD = re.compile(
    r"ads?|advert\w*|adbox|banners?|promo\w*|sponsor\w*|nav(?:bar|igation|s)?|menus?|sidebars?|side|"
    r"footer|masthead|topbar|breadcrumbs?|cookies?|consent|gdpr|notices?|notifications?|alerts?|popup|"
    r"modal|newsletter|subscri\w*|share\w*|sharing|social|related|recommend\w*|comments?|commentlist|"
    r"repl(?:y|ies)|respond|disqus|widgets?|toolbar|paginat\w*|pager|login|signup|signin|search\w*|header"
)
#: Words that such names have beside them.
BESIDE_WORD = re.compile(
    r"site|page|main|top|bottom|left|right|primary|secondary|global|list|box|bar|block|area|section|"
    r"wrap(?:per)?|container|inner|outer|form|links?|buttons?|icons?|posts?|articles?|items?|reader|user|"
    r"js|\d*"
)
INNER = frozenset(("article", "main"))

#: Kinds of tokens: the page itself, part, other tag or end of a part, text, text inside an article.
PAGE, PART, MARK, TEXT, ARTICLE = range(5)
VOCABULARY = "array<struct<token: long, kind: int, times: int, place: int, chars: long, part: long>>"
BLOCKS = "array<struct<at: int, inner: boolean, text: string>>"
STREAM = (
    "page_id long, url string, host string, content long, article long, "
    f"vocabulary {VOCABULARY}, stream array<int>, blocks {BLOCKS}"
)
CLASSES = "array<struct<id: int, tokens: array<long>>>"
SCHEMA = "page_id long, url string, text string, n_chars long"


@dataclass
class Block:
    part: int  # token of the part it stands in
    text: str
    outside: bool  # in a part that is never main text
    inner: bool  # in an article or main part
    linked: int  # characters inside links
    heading: bool = False

    @property
    def chars(self) -> int:
        """Characters outside links, none where the part is not of the main text."""
        return 0 if self.outside else max(0, len(self.text) - self.linked)


@lru_cache(maxsize=1024)
def _named(name: str) -> tuple[str, str | None]:
    """Name of a tag in lower case, and the element without markup that it opens."""
    raw = RAW.match(name)
    return name.lower(), raw and raw[1].lower()


def tags(source: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Start, end, name, whether it closes, and attributes of each tag; other markup has no name.

    A tag that never ends is text, up to the next one. Work is linear in the page: a quote from which no end of
    a tag was found is not followed again, and the next special character is looked up once.
    """
    last = {mark: source.rfind(mark) for mark in "\"'>"}
    hopeless: set[int] = set()
    looked = special = -1

    def end_of(at: int) -> int:
        """Place of the ``>`` of a tag, quoted ones skipped, or -1."""
        nonlocal looked, special
        if at > last[">"]:
            return -1
        if source[at] == ">":
            return at
        if not looked <= at <= special:
            found = SPECIAL.search(source, at)
            looked, special = at, found.start() if found else len(source)
        here = special
        opened = []
        while here < len(source) and here not in hopeless:
            mark = source[here]
            if mark == ">":
                return here
            opened.append(here)
            if here >= last[mark]:
                break
            found = SPECIAL.search(source, source.find(mark, here + 1) + 1)
            here = found.start() if found else len(source)
        hopeless.update(opened)
        return -1

    at = 0
    while (found := TAG.search(source, at)) is not None:
        start, at = found.span()
        if found[3]:
            end = source.find("-->", at)
            at = end + 3 if end >= 0 else len(source)
            yield start, at, "", False, ""
        elif found[4]:
            if at <= last[">"]:
                at = source.find(">", at) + 1
                yield start, at, "", False, ""
        else:
            name, raw = _named(found[2])
            if raw and found[1]:
                if at <= last[">"]:
                    at = source.find(">", at) + 1
                    yield start, at, "", False, ""
                continue
            end = end_of(at)
            if end < 0:
                continue
            if raw:
                closed = RAW_END[raw].search(source, end + 1)
                at = closed.end() if closed else len(source)
                yield start, at, "", False, ""
            else:
                attributes, at = source[at:end], end + 1
                yield start, at, name, bool(found[1]), attributes


def parse(source: str) -> list[tuple[int, int, Block | None]]:
    """Token, kind and block of all tags and texts in page order; parts left open end with the page.

    Paths are hashed part by part, so that deep nesting costs no more than its tags.
    """
    found: list[tuple[int, int, Block | None]] = []
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
    open_tags: Counter = Counter()
    parts: list[str] = []
    links = linked = 0
    heading = False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, path, outside, inner = stack[-1]
                kind = ARTICLE if inner and not outside else TEXT
                block = Block(path, text, outside, inner, linked, heading)
                found.append((_token("article" if kind == ARTICLE else "text", path, text), kind, block))
        linked = 0

    def close() -> str:
        name, path, _, _ = stack.pop()
        open_tags[name] -= 1
        found.append((_mark("end", path, ""), MARK, None))
        return name

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if links:
            linked += len(text)

    at = 0
    for start, end, name, closes, attributes in tags(source):
        if start > at:
            add(source[at:start])
        at = end
        if not name:
            continue
        if name == "br":
            add(" ")
        elif name == "a":
            links = max(0, links + (-1 if closes else 1))
        elif name in STRUCTURE:
            flush()
            links = 0
            heading = False
            if closes:
                if open_tags[name]:
                    while close() != name:
                        pass
            elif not attributes.rstrip().endswith("/"):
                _, path, outside, inner = stack[-1]
                label, own = _described(name, attributes, inner)
                path = _mark("part", path, label)
                found.append((path, PART, None))
                open_tags[name] += 1
                stack.append((name, path, outside or own, inner or (name in INNER and not own)))
        elif name in BREAKS:
            flush()
            heading = name in HEADINGS and not closes
            found.append((_mark("/" if closes else "", stack[-1][1], name), MARK, None))
    if at < len(source):
        add(source[at:])
    flush()
    while len(stack) > 1:
        close()
    return found


def _described(name: str, attributes: str, inner: bool) -> tuple[str, bool]:
    """Label of a tag for its path, and whether the part is outside the main text."""
    found = {}
    if attributes:
        for key, value in ATTRIBUTE.findall(attributes):
            found[key.lower()] = value.strip("\"'").lower()
    names = found.get("class", "").split()
    label = ".".join((name, *names))
    outside = (
        name in OUTSIDE_TAGS
        or (name == "header" and not inner)
        or found.get("role") in OUTSIDE_ROLES
        or "hidden" in found
        or found.get("aria-hidden") == "true"
        or "display:none" in found.get("style", "").replace(" ", "")
        or (name not in ("html", "body") and any(map(_outside, (*names, *found.get("id", "").split()))))
    )
    return label, outside


@lru_cache(maxsize=1 << 14)
def _mark(kind: str, path: int, text: str) -> int:
    return _token(kind, path, text)


@lru_cache(maxsize=4096)
def _outside(name: str) -> bool:
    words = re.split(r"[_-]+", name)
    own = [bool(OUTSIDE_WORD.fullmatch(word)) for word in words]
    return any(own) and all(o or BESIDE_WORD.fullmatch(w) for o, w in zip(own, words, strict=True))


def _token(kind: str, path: int, text: str) -> int:
    raw = f"{kind}\0{path}\0{text}".encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def vocabulary(source: str) -> tuple[int, int, list[tuple[int, ...]], list[int]]:
    """:func:`read_page` without the blocks, and without the places of headings in articles."""
    content, article, words, stream, _ = read_page(source)
    return content, article, words, [place for place in stream if place]


def read_page(
    source: str,
) -> tuple[int, int, list[tuple[int, ...]], list[int], list[tuple[int, bool, str]]]:
    """Content, characters of the article, tokens, the page as places among its tokens, and the blocks that
    may be main text: place in the page, whether inside an article, text.

    Tokens come with kind, times, first place, characters outside links (of a part: of its own blocks) and
    the part that a text stands in. The content tells pages of different main text apart. Headings of an
    article belong to it, however many articles share them, and are no tokens: they stand in the page as the
    token 0, which is of no class.
    """
    found = parse(source)
    texts = [
        (place, block.inner, block.text)
        for place, (_, _, block) in enumerate(found)
        if block is not None and not block.outside
    ]
    blocks = [block for _, _, block in found if block is not None and not block.outside]
    main = [b for b in blocks if b.inner] or blocks
    content = _token("content", 0, "\0".join(b.text for b in main))
    chars: Counter = Counter()
    for block in blocks:
        chars[block.part] += block.chars
    order: dict[int, int] = {0: 0}
    rows = [[0, PAGE, 1, 0, 0, 0]]
    stream = []
    for place, (token, kind, block) in enumerate(found):
        if kind == ARTICLE and block.heading:
            stream.append(0)
            continue
        if token not in order:
            order[token] = len(rows)
            size = chars[token] if kind == PART else 0
            rows.append([token, kind, 0, place, size, 0 if block is None else block.part])
        row = rows[order[token]]
        row[2] += 1
        if block is not None:
            row[4] += block.chars
        stream.append(order[token])
    rows[0][2] = 1
    article = sum(b.chars for b in main)
    return content, article, [tuple(row) for row in rows], stream, texts


def host() -> Column:
    found = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.lower(found))


def misplaced(ranks: list[int], size: int) -> set[int]:
    """Places of a class that leave its order on a page; all of them, where it is not there in whole.

    What stays in each repeat is a longest rising run of places, so what stays everywhere is in order.
    """
    whole = list(range(size))
    wrong: set[int] = set()
    for start in range(0, len(ranks), size):
        part = ranks[start : start + size]
        if part == whole:
            continue
        if sorted(part) != whole:
            return set(whole)
        tails: list[int] = []
        before: dict[int, int | None] = {}
        for rank in part:
            at = bisect_left(tails, rank)
            before[rank] = tails[at - 1] if at else None
            tails[at:] = [rank, *tails[at + 1 :]]
        rank, kept = tails[-1], set()
        while rank is not None:
            kept.add(rank)
            rank = before[rank]
        wrong |= set(whole) - kept
    return wrong


class Template:
    """Classes of a host, the more frequent first."""

    def __init__(self, classes: list[tuple[int, list[int]]]):
        self.tokens = dict(classes)
        self.place = {
            token: (number, rank) for number, tokens in classes for rank, token in enumerate(tokens)
        }

    def out_of_order(self, page: list[int]) -> set[int]:
        """Tokens that leave the order of their class on the page."""
        ranks: dict[int, list[int]] = {}
        for token in page:
            if token in self.place:
                number, rank = self.place[token]
                ranks.setdefault(number, []).append(rank)
        return {
            self.tokens[number][rank]
            for number, found in ranks.items()
            for rank in misplaced(found, len(self.tokens[number]))
        }

    def slots(self, page: list[int]) -> Iterator[tuple[int, int, int, bool]]:
        """For each token of the page: class and gap of its slot, the class it is of, whether that one crosses.

        Outside all classes both are -1, as is the class of a token that is of none. Of two classes that cross, the
        less frequent one is told; its open occurrence is given up.
        """
        stack: list[list[int]] = []
        open_classes: Counter = Counter()
        for token in page:
            number, rank = self.place.get(token, (-1, -1))
            crossing = []
            if number >= 0 and rank:
                if not open_classes[number]:
                    crossing.append(number)
                else:
                    while stack[-1][0] != number:
                        above = stack.pop()[0]
                        open_classes[above] -= 1
                        crossing.append(max(above, number))
            if number < 0 or rank == 0:
                slot = tuple(stack[-1]) if stack else (-1, -1)
            else:
                slot = tuple(stack[-2]) if len(stack) > 1 else (-1, -1)
            yield (*slot, number, False)
            for other in crossing:
                yield (-1, -1, other, True)
            if number >= 0:
                if rank == 0:
                    stack.append([number, 0])
                    open_classes[number] += 1
                elif open_classes[number]:
                    stack[-1][1] = rank
                if rank == len(self.tokens[number]) - 1 and open_classes[number]:
                    stack.pop()
                    open_classes[number] -= 1

    def nesting(self, page: list[int]) -> dict[int, tuple[bool, int, int]]:
        """For each class on the page: whether it crosses another, and the least and the largest slot around it."""
        found: dict[int, tuple[bool, int, int]] = {}
        for outer, gap, number, crosses in self.slots(page):
            if number < 0:
                continue
            if crosses:
                slot = found.get(number, (True, -1, -1))[1:]
                found[number] = (True, *slot)
            else:
                code = -1 if outer < 0 else (outer << 32) + gap
                before = found.get(number, (False, code, code))
                found[number] = (before[0], min(before[1], code), max(before[2], code))
        return found


def _templates(batch: pa.RecordBatch) -> Iterator[Template]:
    """The template of each page of a batch, made once while its host is among the last ones."""
    made: dict[str | None, Template] = {}
    classes = batch.column("classes")
    for row, name in enumerate(batch.column("host").to_pylist()):
        if name not in made:
            if len(made) >= REMEMBERED_HOSTS:
                made.clear()
            made[name] = Template([(c["id"], c["tokens"]) for c in classes[row].as_py() or ()])
        yield made[name]


def streams(pages: DataFrame) -> DataFrame:
    """Pages as tokens and blocks; written, since every step reads them, so that a page is parsed once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("token", pa.int64()), ("kind", pa.int32()), ("times", pa.int32())]
        fields += [("place", pa.int32()), ("chars", pa.int64()), ("part", pa.int64())]
        for batch in batches:
            found = [read_page(source or "") for source in batch.column("html").to_pylist()]
            ends = pa.array(accumulate((len(f[2]) for f in found), initial=0), pa.int32())
            columns = zip(*(word for f in found for word in f[2]), strict=True) if found else [[]] * 6
            words = pa.StructArray.from_arrays(
                [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)],
                names=[name for name, _ in fields],
            )
            text_ends = pa.array(accumulate((len(f[4]) for f in found), initial=0), pa.int32())
            texts = [text for f in found for text in f[4]]
            blocks = pa.StructArray.from_arrays(
                [
                    pa.array([t[0] for t in texts], pa.int32()),
                    pa.array([t[1] for t in texts], pa.bool_()),
                    pa.array([t[2] for t in texts], pa.string()),
                ],
                names=["at", "inner", "text"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    batch.column("host"),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.ListArray.from_arrays(ends, words),
                    pa.array([f[3] for f in found], pa.list_(pa.int32())),
                    pa.ListArray.from_arrays(text_ends, blocks),
                ],
                names=["page_id", "url", "host", "content", "article", "vocabulary", "stream", "blocks"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host().alias("host"), "html")
    return written(rows.mapInArrow(work, STREAM), "streams", compression="zstd")  # mostly text


def candidates(pages: DataFrame) -> DataFrame:
    """``host, id, place, token, kind, chars, part``: tokens of the classes with enough pages, in order.

    ``id`` counts the classes of a host from the most frequent one, ``place`` the tokens inside.
    """
    # One row a token and content before tokens meet, so a token of all pages is not in one place.
    tokens = (
        pages.where("host IS NOT NULL")
        .select("host", "content", "article", F.inline("vocabulary"))
        .groupBy("host", "token", "content")
        .agg(
            F.max("times").alias("times"),
            F.min("place").alias("place"),
            F.max("kind").alias("kind"),
            F.max(F.when(F.col("kind") == PAGE, F.col("article")).otherwise(F.col("chars"))).alias("chars"),
            F.max("part").alias("part"),
        )
        .groupBy("host", "token")
        .agg(
            F.count("*").alias("support"),
            F.sum(F.xxhash64("content", "times").cast("decimal(20,0)")).alias("vector"),
            F.avg("place").alias("place"),
            F.max("kind").alias("kind"),
            F.sum("chars").alias("chars"),
            F.max("part").alias("part"),
        )
        .where(F.col("support") >= MIN_PAGES)
    )
    tokens = written(tokens, "tokens")
    sizes = tokens.where(F.col("kind") == PAGE).select(
        "host", F.col("support").alias("n_contents"), F.col("chars").alias("article")
    )
    everywhere = (F.col("support") == F.col("n_contents")) & (F.col("support") >= MIN_ARTICLES)
    frequent = tokens.where(F.col("kind") != PAGE).join(sizes, "host").where(
        (F.col("support") >= SUPPORT * F.col("n_contents")) & ((F.col("kind") != ARTICLE) | everywhere)
    )
    # Texts that make up half of the articles are articles of near copies.
    repeated = (
        frequent.where(F.col("kind") == ARTICLE)
        .groupBy("host")
        .agg((2 * F.sum("chars") > F.max("article")).alias("copies"))
    )
    classes = (
        frequent.join(repeated, "host", "left")
        .where((F.col("kind") != ARTICLE) | ~F.col("copies"))
        .groupBy("host", "support", "vector")
        .agg(F.sort_array(F.collect_list(F.struct("place", "token", "kind", "chars", "part"))).alias("tokens"))
    )
    ranked = classes.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct(-F.col("support"), -F.size("tokens"), "vector", "tokens"))).alias("c")
    )
    return (
        ranked.select("host", F.posexplode("c").alias("id", "c"))
        .select("host", "id", F.posexplode("c.tokens").alias("place", "t"))
        .select("host", "id", "place", "t.token", "t.kind", "t.chars", "t.part")
    )


def as_classes(tokens: DataFrame) -> DataFrame:
    """``host, classes``: one row a host, bounded by the size of its pages."""
    found = tokens.groupBy("host", "id").agg(
        F.sort_array(F.collect_list(F.struct("place", "token")))["token"].alias("tokens")
    )
    return found.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("id", "tokens"))).alias("classes"))


def met(pages: DataFrame, templates: DataFrame, n_tokens: int, how: str = "inner") -> DataFrame:
    """Pages beside the template of their host: broadcast up to a checked size, else a shuffle."""
    return pages.join(F.broadcast(templates) if n_tokens <= BROADCAST_TOKENS else templates, "host", how)


def templates(pages: DataFrame) -> DataFrame:
    """``host, id, place, token, kind, chars, part``: the tokens of the valid classes of each host."""
    pages = streams(pages)
    return valid(pages, written(candidates(pages), "classes"))


def parts(tokens: DataFrame) -> DataFrame:
    """``host, part``: the frequent part with most characters of its own that are not of frequent texts."""
    is_part = F.col("kind") == PART
    return (
        tokens.where(F.col("kind") != MARK)
        .groupBy("host", F.when(is_part, F.col("token")).otherwise(F.col("part")).alias("part"))
        .agg(
            F.max(is_part).alias("whole"),
            F.sum(F.when(is_part, 1).otherwise(-1) * F.col("chars")).alias("chars"),
        )
        .where("whole AND chars > 0")
        .groupBy("host")
        .agg(F.max_by("part", F.struct("chars", "part")).alias("part"))
    )


def valid(pages: DataFrame, tokens: DataFrame) -> DataFrame:
    """Of the candidates, the tokens of classes with enough tokens that stand in order and nested on all pages."""

    def read(batch: pa.RecordBatch) -> Iterator[tuple[str, Template, list[int]]]:
        names, words, streams = (batch.column(c).to_pylist() for c in ("host", "words", "stream"))
        for name, template, tokens, stream in zip(names, _templates(batch), words, streams, strict=True):
            yield name, template, [tokens[place] for place in stream]

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrong = {(name, token) for name, template, page in read(batch) for token in template.out_of_order(page)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in wrong], pa.string()), pa.array([t for _, t in wrong], pa.int64())],
                names=["host", "token"],
            )

    def nesting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple[str, int], tuple[bool, int, int]] = {}
            for name, template, page in read(batch):
                for number, (crosses, least, most) in template.nesting(page).items():
                    was = rows.get((name, number), (crosses, least, most))
                    rows[name, number] = (was[0] or crosses, min(was[1], least), max(was[2], most))
            columns = list(zip(*((*key, *value) for key, value in rows.items()), strict=True)) or [()] * 5
            kinds = (pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["host", "id", "crosses", "least", "most"],
            )

    def large(tokens: DataFrame) -> DataFrame:
        sizes = tokens.groupBy("host", "id").count().where(F.col("count") >= MIN_TOKENS)
        return tokens.join(sizes, ["host", "id"], "left_semi").select(tokens.columns)

    tokens = written(large(tokens), "large")
    plain = pages.select("host", F.col("vocabulary.token").alias("words"), "stream")
    found = met(plain, as_classes(tokens), tokens.count())
    wrong = written(found.mapInArrow(order, "host string, token long").distinct(), "misplaced")
    if not wrong.isEmpty():
        ordered = tokens.join(wrong, ["host", "token"], "left_anti").select(tokens.columns)
        tokens = written(large(ordered), "ordered")
    open_tokens = tokens
    while True:  # ends: each turn drops a class of every host that it looks at again
        found = met(plain, as_classes(open_tokens), open_tokens.count())
        seen = found.mapInArrow(nesting, "host string, id int, crosses boolean, least long, most long")
        bad = (
            seen.groupBy("host", "id")
            .agg(F.max("crosses").alias("crosses"), F.min("least").alias("least"), F.max("most").alias("most"))
            .where("crosses OR least < most")
            .select("host", "id")
        )
        bad = written(bad, "crossing")
        if bad.isEmpty():
            return tokens
        tokens = written(tokens.join(bad, ["host", "id"], "left_anti").select(tokens.columns), "nested")
        open_tokens = tokens.join(bad.select("host").distinct(), "host", "left_semi")


def extract(source: str, template: Template, part: int | None) -> list[tuple[int, int, str]]:
    """:func:`main_blocks` of the html of one page."""
    _, _, words, stream, texts = read_page(source)
    page = [words[place][0] for place in stream]
    return main_blocks(page, {at: (inner, text) for at, inner, text in texts}, template, part)


def main_blocks(
    page: list[int], texts: dict[int, tuple[bool, str]], template: Template, part: int | None
) -> list[tuple[int, int, str]]:
    """Class and gap of the slot and text of the blocks that belong to the main text, from the tokens of a
    page and the blocks at their places."""
    places = (slot for slot in template.slots(page) if not slot[3])
    blocks: list[tuple[int, int, bool, str, bool]] = []
    within = 0
    end = _token("end", part, "") if part is not None else None
    for at, (token, (number, gap, of, _)) in enumerate(zip(page, places, strict=True)):
        within += (token == part) - (token == end)
        if of < 0 and at in texts:
            blocks.append((number, gap, *texts[at], within > 0))
    if any(inner for inner, _ in texts.values()):
        blocks = [b for b in blocks if b[2]]
    elif any(b[4] for b in blocks):
        blocks = [b for b in blocks if b[4]]
    return [(number, gap, text) for number, gap, _, text, _ in blocks]


def main_slots(pages: DataFrame) -> DataFrame:
    """Pages with ``slots``: class and gap (-1 outside all classes) and text of each block of the main text."""
    parsed = streams(pages)
    frequent = written(candidates(parsed), "classes")
    tokens = valid(parsed, frequent)
    found = written(as_classes(tokens).join(parts(frequent), "host", "full"), "templates")
    rows = met(
        parsed.select("page_id", "url", "host", F.col("vocabulary.token").alias("words"), "stream", "blocks"),
        found,
        tokens.count(),
        "left",
    ).select("page_id", "url", "host", "words", "stream", "blocks", "classes", "part")
    slot = pa.struct([("class", pa.int32()), ("gap", pa.int32()), ("text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("words", "stream", "blocks", "part"))
            for template, words, stream, blocks, part in zip(_templates(batch), *columns, strict=True):
                texts = {block["at"]: (block["inner"], block["text"]) for block in blocks}
                page = [words[place] for place in stream]
                found.append(
                    [{"class": c, "gap": g, "text": t} for c, g, t in main_blocks(page, texts, template, part)]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.list_(slot))],
                names=["page_id", "url", "slots"],
            )

    return rows.mapInArrow(
        work, "page_id long, url string, slots array<struct<class: int, gap: int, text: string>>"
    )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    A null or empty page has empty text. Pages without a host in their url, and hosts with one
    different page, have no template and are read by their own parts. A tag whose quote never closes is
    text, and costs no more than any. Every row stands for itself; further columns are ignored.
    """
    text = F.array_join("slots.text", "\n\n")
    return main_slots(pages).select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
