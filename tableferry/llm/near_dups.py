"""MinHash near-duplicates by an inverted join over signature coordinates.

Texts with the same words are one class. Each class has a signature of ``COORDINATES`` minima and is
posted under its pairs (coordinate, value). Two classes as similar as asked for agree in
:func:`matches_of` coordinates or more (:func:`miss_chance` gives the odds against it), so they share a
pair among each one's rarest ``COORDINATES - matches + 1``: only those prefixes are joined, and the frequent pairs at
the end are skipped. Candidates count their collisions on the whole signatures, and those at or above
the match threshold are confirmed on the full shingle sets.

A list is joined to one of its members first (the one whose pairs are the most frequent: of a group
of near copies, the one nearest to all); a list whose members are then one component needs no further
pairs. What remains is compared pair by pair, so no link between components is lost: short lists by
a join, long ones in cells of two blocks, which give no more links than they have members.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import light, slices, tidy, without, written

WORDS = 5
SIMILARITY = 85  # per cent
COORDINATES = 32
#: Bound of the chance that a pair as similar as asked for is missed.
MISS = 1e-6

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: White space that parts words; anything else is part of one.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SCALE = _rng.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)

SIGNED = "doc_id long, node binary, n_shingles long, signature array<int>"
TEXTS = "node binary, text string"
#: Characters of text that a worker holds at a time.
SLICE_CHARS = 1_000_000
#: Lists of more members than this are compared in cells of blocks of about so many members.
SHORT_LIST, BLOCK = 48, 512


def missed(similarity: float, matches: int) -> float:
    """Chance that two texts of this similarity agree in fewer than ``matches`` coordinates."""
    return sum(
        math.comb(COORDINATES, k) * similarity**k * (1 - similarity) ** (COORDINATES - k)
        for k in range(matches)
    )


def matches_of(similarity: int) -> int:
    """The most matches that a pair of this similarity (per cent) lacks with a chance below ``MISS``."""
    return max(m for m in range(1, COORDINATES + 1) if m == 1 or missed(similarity / 100, m) < MISS)


def miss_chance(similarity: float = SIMILARITY / 100) -> float:
    """Chance that two texts of this similarity are missed where it is the one asked for."""
    return missed(similarity, matches_of(round(100 * similarity)))


_powers: dict[str, np.ndarray] = {}


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse (modulo 2^64), kept for the sizes usual in a worker."""
    if len(_powers.get("up", ())) < size:
        grown = max(size, 1 << 15)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            run = np.full(grown, base, dtype=np.uint64)
            run[0] = 1
            _powers[name] = np.cumprod(run, dtype=np.uint64)
    return _powers["up"][:size], _powers["down"][:size]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def normal_words(text: str) -> bytes:
    """The words in lower case (A-Z), single spaces between."""
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(_LOWER).split())


def shingles(words: bytes) -> np.ndarray:
    """Hashes of the distinct runs of five words, sorted; fewer words are one run."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(words, dtype=np.uint8)
    spaces = np.flatnonzero(raw == 0x20)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(raw)]])
    up, down = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    word = _mixed((total[ends] - total[starts]) * down[starts])
    order = min(WORDS, len(word))
    size = len(word) - order + 1
    run = np.zeros(size, dtype=np.uint64)
    for place in range(order):
        run += word[place : place + size] * _STEP[place]
    run = _mixed(run + np.uint64(order))
    run.sort()
    first = np.ones(size, dtype=bool)
    first[1:] = run[1:] != run[:-1]
    return run[first]


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum of each coordinate, as 32 bits."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(COORDINATES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(high), 8192):
        part = _SCALE[:, None] * high[at : at + 8192] + _SHIFT[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return low.view(np.int32)


def _node(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def signed(documents: DataFrame) -> DataFrame:
    """``doc_id, node, n_shingles, signature`` of every row; no node without words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, signatures = [], [], []
            for text in batch.column("text"):
                words = normal_words(text.as_py() or "")
                hashes = shingles(words)
                nodes.append(_node(words) if len(hashes) else None)
                sizes.append(len(hashes))
                signatures.append(signature(hashes) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.list_(pa.int32())),
                ],
                names=["doc_id", "node", "n_shingles", "signature"],
            )
        tidy()

    return documents.select("doc_id", "text").mapInArrow(work, SIGNED)


def prefixes(classes: DataFrame, similarity: int) -> DataFrame:
    """``node, n_shingles, weight, prefix``: the shared pairs under which a class is posted.

    ``weight`` sums how many classes hold its pairs.

    Pairs are ranked by how many classes hold them, the rarest first; pairs that one class holds come
    before all others and lead to no one, so a class with enough of them is not posted at all.
    """
    postings = classes.select(
        "node",
        "n_shingles",
        F.posexplode("signature").alias("coordinate", "value"),
    ).select(
        "node",
        "n_shingles",
        F.expr("shiftleft(cast(coordinate AS bigint), 32) | (cast(value AS bigint) & 4294967295)").alias("key"),
    )
    shared = postings.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1")
    length = COORDINATES - matches_of(similarity) + 1
    return (
        postings.join(shared, "key")
        .groupBy("node", "n_shingles")
        .agg(
            F.sort_array(F.collect_list(F.struct("holders", "key"))).alias("pairs"),
            F.sum("holders").alias("weight"),
        )
        .select(
            "node",
            "n_shingles",
            "weight",
            F.expr(
                f"slice(pairs, 1, greatest(0, {length} - ({COORDINATES} - size(pairs)))).key"
            ).alias("prefix"),
        )
        .where(F.size("prefix") > 0)
    )


def colliding(pairs: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``a, b`` whose signatures agree in enough coordinates and whose sizes allow a link."""
    side = classes.select("node", "n_shingles", "signature")
    both = pairs.join(
        side.select(
            F.col("node").alias("b"), F.col("signature").alias("sb"), F.col("n_shingles").alias("nb")
        ),
        "b",
    ).join(
        side.select(
            F.col("node").alias("a"), F.col("signature").alias("sa"), F.col("n_shingles").alias("na")
        ),
        "a",
    )
    matches = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
    sized = 100 * F.least("na", "nb") >= similarity * F.greatest("na", "nb")
    return both.where(sized).where(matches >= matches_of(similarity)).select("a", "b")


def texts_of(documents: DataFrame, members: DataFrame) -> DataFrame:
    """``node, text`` (normal words) of the classes ``node, doc_id``, found by the id of each.

    Classes without an id are found by their node, among all rows without an id.
    """
    ids = light(members.where("doc_id IS NOT NULL").select("doc_id").distinct())
    rows = documents.select("doc_id", "text")
    texts = _normal_texts(rows.join(ids, "doc_id", "left_semi"))
    nameless = members.where("doc_id IS NULL").select("node").distinct()
    if not nameless.isEmpty():
        others = _normal_texts(rows.where("doc_id IS NULL")).dropDuplicates(["node"])
        texts = texts.unionByName(others.join(nameless, "node", "left_semi"))
    return texts.dropDuplicates(["node"])


def _normal_texts(rows: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices((t.as_py() for t in batch.column("text")), SLICE_CHARS):
                words = [normal_words(text) for text in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_node(w) for w in words], pa.binary()),
                        pa.array([w.decode("utf-8", "surrogatepass") for w in words], pa.string()),
                    ],
                    names=["node", "text"],
                )
        tidy()

    return rows.select("text").mapInArrow(work, TEXTS)


def confirmed(
    pairs: DataFrame, documents: DataFrame, classes: DataFrame, similarity: int
) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    members = classes.join(ends, "node").select("node", "doc_id")
    texts = written(texts_of(documents, members), "texts")
    rows = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            keep = []
            for a, ta, tb in zip(
                batch.column("a"), batch.column("ta"), batch.column("tb"), strict=True
            ):
                name = a.as_py()
                if name != last:  # sorted by the join, so one side is usually the one before
                    last, left = name, shingles(ta.as_py().encode("utf-8", "surrogatepass"))
                right = shingles(tb.as_py().encode("utf-8", "surrogatepass"))
                shared = len(np.intersect1d(left, right, assume_unique=True))
                union = len(left) + len(right) - shared
                keep.append(100 * shared >= similarity * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        tidy()

    return rows.select("a", "b", "ta", "tb").mapInArrow(work, "a binary, b binary")


def cells(
    members: DataFrame, classes: DataFrame, documents: DataFrame, similarity: int
) -> DataFrame:
    """Links between different components of long lists, found in cells of two blocks each.

    ``members``: ``key, node, root, n_shingles, prefix, size``. Each member meets every block of its
    list once. A cell compares signatures, and confirms a pair of components on the full sets unless
    links of this cell already join them. A pair in several lists is left to the list with its
    smallest common key.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    placed = members.withColumn("blocks", blocks).withColumn("block", own)
    ids = placed.select("node").distinct().join(classes, "node")
    texts = written(texts_of(documents, ids.select("node", "doc_id")), "texts")
    full = placed.join(classes.select("node", "signature"), "node").join(texts, "node")
    dealt = (
        full.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .select("key", "lo", "hi", "block", "node", "root", "prefix", "signature", "text")
    )
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(parts, "key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi", "node")
        .mapInArrow(partial(_cells, similarity), "a binary, b binary")
    )


def _cells(similarity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            cell = row["key"], row["lo"], row["hi"]
            if cell != name:
                yield _links_of(name, rows, similarity)
                name, rows = cell, []
            rows.append(row)
    yield _links_of(name, rows, similarity)
    tidy()


def _links_of(
    cell: tuple[int, int, int] | None, rows: list[dict], similarity: int
) -> pa.RecordBatch:
    matches = matches_of(similarity)
    parent: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    links: list[tuple[bytes, bytes]] = []
    sets: dict[int, np.ndarray] = {}

    def members(place: int) -> np.ndarray:
        if place not in sets:
            sets[place] = shingles(rows[place]["text"].encode("utf-8", "surrogatepass"))
        return sets[place]

    if rows:
        key, lo, hi = cell
        left = [i for i, row in enumerate(rows) if row["block"] == lo]
        right = np.array([i for i, row in enumerate(rows) if row["block"] == hi], dtype=np.int64)
        signatures = np.array([row["signature"] for row in rows], dtype=np.int32)
        prefixes_of = [set(row["prefix"]) for row in rows]
        for i in left:
            others = right[right > i] if lo == hi else right
            if not len(others):
                continue
            enough = (signatures[others] == signatures[i]).sum(axis=1) >= matches
            for j in others[enough].tolist():
                a, b = find(rows[i]["root"]), find(rows[j]["root"])
                if a == b or min(prefixes_of[i] & prefixes_of[j]) != key:
                    continue
                x, y = members(i), members(j)
                if 100 * min(len(x), len(y)) < similarity * max(len(x), len(y)):
                    continue
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= similarity * (len(x) + len(y) - shared):
                    parent[a] = b
                    links.append((rows[i]["node"], rows[j]["node"]))
    return pa.RecordBatch.from_arrays(
        [pa.array([link[side] for link in links], pa.binary()) for side in (0, 1)], names=["a", "b"]
    )


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node, by alternating large and small stars.

    Each round replaces links by links to smaller nodes; its state is a written table.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u != v")
        .distinct(),
        "edges",
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        edges = written(small.select("e.u", "e.v").where("u != v").distinct(), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def open_lists(posted: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members of the lists that are not yet one component: ``key, node, root, size`` and what is posted."""
    rooted = posted.withColumn("root", F.col("node"))
    if found is not None:
        rooted = posted.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = rooted.withColumn("key", F.explode("prefix"))
    lists = (
        members.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
        .where("low != high")
        .select("key", "size")
    )
    return written(members.join(lists, "key"), "open")


def near_duplicates(documents: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document; see :func:`labelled`."""
    return labelled(documents, similarity).select("doc_id", "n_shingles", "component_id", "kept")


def labelled(documents: DataFrame, similarity: int) -> DataFrame:
    """``doc_id, node, n_shingles, component_id, kept, main`` of every document.

    Texts of ``similarity`` per cent or more are linked. ``component_id`` is the smallest id reachable over links; a document without words (null, empty or
    white space) is linked with nothing and is its own component. Rows that repeat an id are told apart
    by their texts. A row without an id takes part, and is kept only if nothing with an id is in its
    component, which then is null. ``main`` tells the one node of a component that has its id (null
    without words). Further columns are ignored.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(signed(documents), "signed")
    classes = written(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        ),
        "classes",
    )
    posted = written(prefixes(classes, similarity), "prefixes")
    found = None
    links: list[DataFrame] = []
    tested: list[DataFrame] = []
    for hub in ("max_by(me, struct(weight, me.node))", "min(me)", None):
        members = open_lists(posted, found)
        if members.isEmpty():
            break
        if hub is None:
            short = members.where(f"size <= {SHORT_LIST}")
            long = members.where(f"size > {SHORT_LIST}")
            links.append(written(cells(long, classes, documents, similarity), "links"))
        else:
            short = members
        side = short.select("key", "weight", F.struct("node", "root", "n_shingles").alias("me"))
        hubs = side if hub is None else side.groupBy("key").agg(F.expr(hub).alias("me"))
        pairs = (
            side.select("key", F.col("me").alias("x"))
            .join(hubs.select("key", F.col("me").alias("y")), "key")
            .where("x.root != y.root" + (" AND x.node < y.node" if hub is None else ""))
            .where(
                100 * F.least("x.n_shingles", "y.n_shingles")
                >= similarity * F.greatest("x.n_shingles", "y.n_shingles")
            )
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
            .distinct()
        )
        for before in tested:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        candidates = written(colliding(pairs, classes, similarity), "candidates")
        tested.append(candidates)
        links.append(written(confirmed(candidates, documents, classes, similarity), "links"))
        found = components(reduce(DataFrame.unionByName, links))
    if found is None:
        found = classes.select("node", F.col("node").alias("root")).limit(0)
    labels = (
        classes.select("node", "doc_id")
        .join(found, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    # The smallest id, and of its texts (or of all, without ids) the smallest node.
    least = labels.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))).alias("least")
    )
    named = labels.join(least, "root").select(
        "node",
        F.col("least.doc_id").alias("component_id"),
        (F.col("node") == F.col("least.node")).alias("main"),
    )
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "node", "n_shingles").join(named, "node", "left").select(
        "doc_id",
        "node",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        "main",
    )


def one_of_each(documents: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The documents with one row of each component, of the smallest id; all columns.

    Rows without an id go if one with an id is in their component, else one of them stays. Of rows
    that repeat an id each is judged by its own text. Documents without words stay.
    """
    found = written(labelled(documents, similarity), "near").withColumn(
        "stays", F.expr("node IS NULL OR (kept AND main)")
    )
    ids = written(
        found.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.bool_or("stays").alias("any"), F.expr("count(*) > 1 AND count(node) > 0").alias("mixed")),
        "ids",
    )
    # Rows that their id tells apart go or stay by it; the others by id and text.
    named = without(documents, ids.where("NOT any OR mixed").select("doc_id"))
    named = named.where(F.col("doc_id").cast("long").isNotNull())
    mixed = light(ids.where("any AND mixed").select("doc_id"))
    if not mixed.isEmpty():
        stay = found.where("stays").join(mixed, "doc_id", "left_semi")
        named = named.unionByName(_one_of_each_text(_with_ids(documents, mixed), stay))
    if not found.where("doc_id IS NULL").isEmpty():
        nameless = documents.where(F.col("doc_id").cast("long").isNull())
        stay = found.where("stays AND doc_id IS NULL")
        named = named.unionByName(_one_of_each_text(nameless, stay))
    return named


def _with_ids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    ids = ids.toDF("wanted")
    return documents.join(ids, documents["doc_id"].cast("long") == ids["wanted"], "left_semi")


def _one_of_each_text(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """One of the rows of each id and text in ``wanted``, and all rows without words; all columns.

    All rows have an id, or none has.
    """

    @F.arrow_udf("binary")
    def node_of(texts: pa.Array) -> pa.Array:
        words = [normal_words(t.as_py() or "") for t in texts]
        return pa.array([_node(w) if w else None for w in words], pa.binary())

    node, number = (_free(documents, name) for name in ("node", "number"))
    # 0 for no id: rows dealt out by plain values are joined by them without being dealt out again.
    id_of = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    rows = documents.withColumn(node, node_of("text")).withColumn(number, id_of)
    wanted = wanted.where("node IS NOT NULL").select("node", id_of).distinct().toDF("a", "b")
    # One row of each id and text first, so that many copies are not joined in one place.
    one = rows.where(F.col(node).isNotNull()).dropDuplicates([node, number])
    kept = one.join(wanted, (one[node] == wanted["a"]) & (one[number] == wanted["b"]), "left_semi")
    return rows.where(F.col(node).isNull()).unionByName(kept).drop(node, number)


def _free(documents: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {column.lower() for column in documents.columns}
    while name in taken:
        name += "_"
    return name
