"""Hard negatives from blocks of vectors along a Hilbert curve, chosen by interval arithmetic.

Vectors are whole numbers per dimension. Sorted by label and by their place on a Hilbert curve through all
dimensions, they are cut into blocks, written as a Parquet table; the least and greatest value of each dimension
in a block is its zone map. The inner product of an anchor with any row of a block lies between the two
sums of products that interval arithmetic gives. An anchor has windows of scores, and reads a block only
if that interval meets one of them. First the window is open above and begins at the anchor's fifth
best score within its own block, which gives its positives; then each positive makes a window below it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.common import written

#: A component becomes the whole number below so many times its value.
SCALE = 256
ANCHORS, RELABELLED, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: Share of the positive's score that a negative has, in per cent.
LEAST, MOST = 50, 95
#: Rows of a block, blocks of a bundle (which one task holds), rows of a task that cuts blocks.
ROWS, BUNDLE, PART_ROWS = 256, 64, 1 << 14
#: Bits of each dimension that the curve goes by.
BITS = 4
#: Anchors are compared in groups of those of about so many blocks; picks travel by so many anchors.
GROUP_PARTS, PICKED = 3, 256
#: Blocks whose zones one task compares with a group, and groups that one task reads a bundle for.
ZONES, READERS = 1 << 16, 64
LOWEST, HIGHEST = -(1 << 62), 1 << 62
NO_ID = (1 << 63) - 1

CLEAN = "vec_id long, label long, q binary"
BLOCKS = """
    block long, bundle long, dims int, lab_lo long, lab_hi long, lo binary, hi binary,
    ids array<long>, labels array<long>, q binary, anchors array<struct<pos:int,floor:long>>
"""
PICKS = """
    bundle long, part int, dims int, akeys array<long>, labels array<long>, windows binary, q binary,
    blocks array<long>, bits binary
"""
FOUND = "akey long, w int, score long, vec_id long"


def matrix(rows: list[bytes], dims: int) -> np.ndarray:
    """Vectors as rows of a matrix; a shorter one is filled up with zeros."""
    if all(len(row) == 4 * dims for row in rows):
        return np.frombuffer(b"".join(rows), dtype="<i4").reshape(len(rows), dims).astype(np.int64)
    out = np.zeros((len(rows), dims), dtype=np.int64)
    for place, row in enumerate(rows):
        out[place, : len(row) // 4] = np.frombuffer(row, dtype="<i4")
    return out


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, dtype="<i4").tobytes()


def unpacked(raw: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i4").reshape(rows, dims).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of rows, exact; a dimension that one side lacks is zero there."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims], b[:, :dims]
    if not (a.size and b.size):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if int(np.abs(a).max()) * int(np.abs(b).max()) * dims < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that any vector between ``low`` and ``high`` can have."""
    above, below = np.maximum(a, 0), np.minimum(a, 0)
    least = products(above, low) + products(below, high)
    return least, products(above, high) + products(below, low)


def hilbert(cells: np.ndarray) -> list[bytes]:
    """Places on the Hilbert curve of points with ``BITS`` bits in each dimension, as sortable bytes."""
    points = cells.astype(np.uint32).T.copy()
    dims, rows = points.shape
    if not dims:
        return [b""] * rows
    none = np.uint32(0)
    for bit in range(BITS - 1, 0, -1):
        lower = np.uint32((1 << bit) - 1)
        for axis in range(dims):
            has_bit = (points[axis] >> np.uint32(bit)) & np.uint32(1) == 1
            swapped = np.where(has_bit, none, (points[0] ^ points[axis]) & lower)
            points[axis] ^= swapped
            points[0] ^= np.where(has_bit, lower, swapped)
    points = np.bitwise_xor.accumulate(points, axis=0)
    turn = np.zeros(rows, dtype=np.uint32)
    for bit in range(BITS - 1, 0, -1):
        has_bit = (points[-1] >> np.uint32(bit)) & np.uint32(1) == 1
        turn ^= np.where(has_bit, np.uint32((1 << bit) - 1), none)
    points ^= turn
    bits = [(points >> np.uint32(bit)) & np.uint32(1) for bit in range(BITS - 1, -1, -1)]
    keys = np.packbits(np.concatenate(bits).astype(np.uint8).T, axis=1)
    return [key.tobytes() for key in keys]


def cleaned(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, q`` of the rows that take part: labels moved, components as whole numbers.

    Left out, beside nulls and what is not finite: vectors whose components are so large that an inner
    product could leave 64 bits (beyond about a million in 64 dimensions).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
            values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lengths)), lengths)
            most = [min((1 << 31) - 1, math.isqrt((1 << 62) // max(1, n))) for n in lengths.tolist()]
            whole = np.floor(SCALE * values)
            fits = np.abs(whole) <= np.array(most, dtype=np.float64)[row]  # false if not finite
            good = np.bincount(row, ~fits, minlength=len(lengths)) == 0
            raw = packed(np.where(fits, whole, 0))
            ends = np.r_[0, np.cumsum(4 * lengths)].tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([raw[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary()),
                ],
                names=["vec_id", "label", "q"],
            ).filter(pa.array(good, pa.bool_()))

    moved = F.expr(
        f"CASE WHEN vec_id % {RELABELLED} = 0 THEN (cast(label AS bigint) + 1) % {LABELS}"
        " ELSE cast(label AS bigint) END"
    )
    rows = embeddings.where("label IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), "embedding"
    )
    return rows.mapInArrow(work, CLEAN)


def extent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("q").to_pylist()
            dims = max(map(len, vectors), default=0) // 4
            if dims:
                values = matrix(vectors, dims)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(dims, dtype=np.int32)),
                        pa.array(values.min(axis=0)),
                        pa.array(values.max(axis=0)),
                    ],
                    names=["dim", "lo", "hi"],
                )

    parts = rows.select("q").mapInArrow(work, "dim int, lo long, hi long")
    found = parts.groupBy("dim").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    low, high = np.zeros(len(found), dtype=np.int64), np.zeros(len(found), dtype=np.int64)
    for row in found:
        low[row["dim"]], high[row["dim"]] = row["lo"], row["hi"]
    return low, high


def in_blocks(rows: DataFrame) -> DataFrame:
    """The candidate blocks with their zone maps, written; see ``BLOCKS``.

    Ranges of label and place on the curve are dealt to tasks of about ``PART_ROWS`` rows; equal vectors
    are told apart by id and by their place in the table, so many copies do not meet in one task.
    """
    low, high = extent(rows)
    parts = max(1, math.ceil(rows.count() / PART_ROWS))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column("q").to_pylist(), len(low))
            cells = ((values - low) << BITS) // (high - low + 1)
            yield batch.append_column("curve", pa.array(hilbert(cells), pa.binary()))

    order = ["label", "curve", "vec_id", "nth"]
    dealt = (
        rows.mapInArrow(keyed, f"{CLEAN}, curve binary")
        .withColumn("nth", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("vec_id", "label", "q", F.spark_partition_id().alias("pid"))
    )
    return written(dealt.mapInArrow(_cut, BLOCKS), "blocks")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[dict] = []
    seq = 0
    for batch in batches:
        waiting += batch.to_pylist()
        full = len(waiting) // ROWS
        if full:
            yield _block_rows([waiting[i * ROWS : (i + 1) * ROWS] for i in range(full)], seq)
            seq, waiting = seq + full, waiting[full * ROWS :]
    if waiting:
        yield _block_rows([waiting], seq)


def _block_rows(blocks: list[list[dict]], seq: int) -> pa.RecordBatch:
    out = []
    for place, rows in enumerate(blocks):
        block = (rows[0]["pid"] << 24) + seq + place
        dims = max(len(row["q"]) for row in rows) // 4
        values = matrix([row["q"] for row in rows], dims)
        labels = np.array([row["label"] for row in rows], dtype=np.int64)
        own = [i for i, row in enumerate(rows) if row["vec_id"] is not None and row["vec_id"] % ANCHORS == 0]
        scores = products(values[own], values)
        floors = []
        for i, line in zip(own, scores, strict=True):
            others = np.delete(line, i)[np.delete(labels == labels[i], i)]
            floors.append(int(np.sort(others)[-POSITIVES]) if len(others) >= POSITIVES else LOWEST)
        out.append(
            {
                "block": block,
                "bundle": (rows[0]["pid"] << 24) + (seq + place) // BUNDLE,
                "dims": dims,
                "lab_lo": int(labels.min()),
                "lab_hi": int(labels.max()),
                "lo": packed(values.min(axis=0)),
                "hi": packed(values.max(axis=0)),
                "ids": [row["vec_id"] for row in rows],
                "labels": labels.tolist(),
                "q": packed(values),
                "anchors": [{"pos": i, "floor": f} for i, f in zip(own, floors, strict=True)],
            }
        )
    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [
            ("block", pa.int64()), ("bundle", pa.int64()), ("dims", pa.int32()),
            ("lab_lo", pa.int64()), ("lab_hi", pa.int64()), ("lo", pa.binary()), ("hi", pa.binary()),
            ("ids", longs), ("labels", longs), ("q", pa.binary()),
            ("anchors", pa.list_(pa.struct([("pos", pa.int32()), ("floor", pa.int64())]))),
        ]
    )
    return pa.RecordBatch.from_pylist(out, schema=schema)


def windows_array(windows: list[list[dict]]) -> np.ndarray:
    """Windows of anchors as ``anchor, window, (lo, hi)``; a window that is not there holds nothing."""
    most = max([1, *(w["w"] for own in windows for w in own)])
    out = np.tile(np.array([HIGHEST, LOWEST], dtype=np.int64), (len(windows), most, 1))
    for place, own in enumerate(windows):
        for w in own:
            out[place, w["w"] - 1] = w["lo"], w["hi"]
    return out


def _choose(same: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by group: its anchors, then the zones of blocks, bundle by bundle."""
    name, group = None, None
    anchors: list[dict] = []
    zones: list[dict] = []

    def settle() -> Iterator[pa.RecordBatch]:
        nonlocal group
        if group is None and anchors:
            dims = max(len(a["q"]) for a in anchors) // 4
            group = (
                matrix([a["q"] for a in anchors], dims),
                np.array([a["label"] for a in anchors], dtype=np.int64),
                np.array([a["akey"] for a in anchors], dtype=np.int64),
                windows_array([a["windows"] for a in anchors]),
            )
        if group is not None and zones:
            yield from _picked(same, name[0], group, zones)
        zones.clear()

    for batch in batches:
        for row in batch.to_pylist():
            key = row["grp"], row["salt"]
            if key != name:
                yield from settle()
                name, group = key, None
                anchors.clear()
            if row["anchor"] is not None:
                anchors.append(row["anchor"])
                continue
            zone = row["zone"]
            if len(zones) >= 1024 and zone["bundle"] != zones[-1]["bundle"]:
                yield from settle()
            zones.append(zone)
    yield from settle()


def _picked(same: bool, grp: int, group: tuple, zones: list[dict]) -> Iterator[pa.RecordBatch]:
    values, labels, akeys, windows = group
    dims = max(len(z["lo"]) for z in zones) // 4
    low, high = matrix([z["lo"] for z in zones], dims), matrix([z["hi"] for z in zones], dims)
    least, greatest = bounds(values, low, high)
    meets = np.zeros(least.shape, dtype=bool)
    for w in range(windows.shape[1]):
        meets |= (greatest >= windows[:, w, :1]) & (least <= windows[:, w, 1:])
    lab_lo = np.array([z["lab_lo"] for z in zones])
    lab_hi = np.array([z["lab_hi"] for z in zones])
    own = labels[:, None]
    meets &= (lab_lo <= own) & (own <= lab_hi) if same else ~((lab_lo == own) & (lab_hi == own))
    bundles = np.array([z["bundle"] for z in zones], dtype=np.int64)
    blocks = np.array([z["block"] for z in zones], dtype=np.int64)
    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [
            ("bundle", pa.int64()), ("part", pa.int32()), ("dims", pa.int32()), ("akeys", longs),
            ("labels", longs), ("windows", pa.binary()), ("q", pa.binary()), ("blocks", longs),
            ("bits", pa.binary()),
        ]
    )
    out = []
    for bundle in np.unique(bundles):
        columns = np.flatnonzero(bundles == bundle)
        columns = columns[meets[:, columns].any(axis=0)]
        chosen = np.flatnonzero(meets[:, columns].any(axis=1))
        for at in range(0, len(chosen), PICKED):
            some = chosen[at : at + PICKED]
            out.append(
                {
                    "bundle": int(bundle),
                    "part": grp // READERS,
                    "dims": values.shape[1],
                    "akeys": akeys[some].tolist(),
                    "labels": labels[some].tolist(),
                    "windows": windows[some].tobytes(),
                    "q": packed(values[some]),
                    "blocks": blocks[columns].tolist(),
                    "bits": np.packbits(meets[np.ix_(some, columns)]).tobytes(),
                }
            )
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _read(same: bool, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bundle: the chosen blocks of it, then the picks."""
    name, held = None, None
    blocks: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            key = row["bundle"], row["part"]
            if key != name:
                name, held = key, None
                blocks.clear()
            if row["block"] is not None:
                blocks.append(row["block"])
                continue
            if held is None:
                dims = max(b["dims"] for b in blocks)
                held = (
                    np.concatenate(
                        [
                            np.pad(unpacked(b["q"], len(b["ids"]), b["dims"]), ((0, 0), (0, dims - b["dims"])))
                            for b in blocks
                        ]
                    ),
                    np.array([NO_ID if i is None else i for b in blocks for i in b["ids"]], dtype=np.int64),
                    np.array([x for b in blocks for x in b["labels"]], dtype=np.int64),
                    np.concatenate([b["block"] * ROWS + np.arange(len(b["ids"])) for b in blocks]),
                )
            yield _best(same, most, row["pick"], *held)


def _best(
    same: bool, most: int, pick: dict, values: np.ndarray, ids: np.ndarray, labels: np.ndarray, keys: np.ndarray
) -> pa.RecordBatch:
    """The first rows in each window of each picked anchor, among the blocks picked for it."""
    rows = len(pick["akeys"])
    akeys = np.array(pick["akeys"], dtype=np.int64)
    windows = np.frombuffer(pick["windows"], dtype=np.int64).reshape(rows, -1, 2)
    blocks = np.array(pick["blocks"], dtype=np.int64)
    bits = np.unpackbits(np.frombuffer(pick["bits"], dtype=np.uint8), count=rows * len(blocks))
    bits = bits.reshape(rows, len(blocks)).astype(bool)
    # The bundle holds what any pick wants: this one's blocks are sorted, as bundles come.
    at = np.searchsorted(blocks, keys // ROWS).clip(0, len(blocks) - 1)
    read = blocks[at] == keys // ROWS
    values, ids, labels, keys, at = values[read], ids[read], labels[read], keys[read], at[read]
    scores = products(unpacked(pick["q"], rows, pick["dims"]), values)
    alike = np.array(pick["labels"], dtype=np.int64)[:, None] == labels
    fits = bits[:, at] & (alike if same else ~alike)
    fits &= (scores >= windows[:, :, 0].min(axis=1)[:, None]) & (scores <= windows[:, :, 1].max(axis=1)[:, None])
    if same:
        fits &= akeys[:, None] != keys
    anchor, row = np.nonzero(fits)
    score = scores[anchor, row]
    order = np.lexsort((ids[row], -score, anchor))
    anchor, row, score = anchor[order], row[order], score[order]
    found = []
    for w in range(windows.shape[1]):
        inside = (score >= windows[anchor, w, 0]) & (score <= windows[anchor, w, 1])
        a, r, s = anchor[inside], row[inside], score[inside]
        first = np.searchsorted(a, a)
        keep = np.arange(len(a)) - first < most
        found.append((akeys[a[keep]], np.full(keep.sum(), w + 1, dtype=np.int32), s[keep], ids[r[keep]]))
    akey, w, score, vec_id = (np.concatenate(column) for column in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(akey, pa.int64()),
            pa.array(w, pa.int32()),
            pa.array(score, pa.int64()),
            pa.array(vec_id, pa.int64(), mask=vec_id == NO_ID),
        ],
        names=["akey", "w", "score", "vec_id"],
    )


def search(anchors: DataFrame, blocks: DataFrame, groups: int, same: bool, most: int) -> DataFrame:
    """``akey, w, rank, score, vec_id``: the first ``most`` rows in each window of each anchor.

    ``anchors``: ``akey, grp, label, q, windows``. With ``same`` rows of the anchor's label but itself
    are looked at, else those of other labels. The zones of all blocks meet each group of anchors,
    then the blocks that some anchor has to read meet the anchors that read them.
    """
    spark = blocks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = math.ceil(blocks.count() / ZONES)
    anchor, zone = F.struct("akey", "label", "q", "windows"), ("block", "bundle", "lab_lo", "lab_hi", "lo", "hi")
    both = anchors.select(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), anchor.alias("anchor")
    ).unionByName(
        blocks.select(
            F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("grp"),
            F.pmod(F.xxhash64("bundle"), F.lit(salts)).cast("int").alias("salt"),
            F.struct(*zone).alias("zone"),
        ),
        allowMissingColumns=True,
    )
    picks = written(
        both.repartition(parts, "grp", "salt")
        .sortWithinPartitions("grp", "salt", F.col("zone").isNotNull(), "zone.bundle", "zone.block", "anchor.akey")
        .mapInArrow(partial(_choose, same), PICKS),
        "picks",
    )
    chosen = picks.select("part", F.explode("blocks").alias("block")).distinct()
    payload = F.struct("block", "dims", "ids", "labels", "q")
    reading = (
        blocks.join(chosen, "block")
        .select("bundle", "part", payload.alias("block"))
        .unionByName(
            picks.select(
                "bundle", "part",
                F.struct("dims", "akeys", "labels", "windows", "q", "blocks", "bits").alias("pick"),
            ),
            allowMissingColumns=True,
        )
    )
    found = (
        reading.repartition(parts, "bundle", "part")
        .sortWithinPartitions("bundle", "part", F.col("pick").isNotNull(), "block.block")
        .mapInArrow(partial(_read, same, most), FOUND)
    )
    order = Window.partitionBy("akey", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _window(score: str) -> Column:
    """``w, lo, hi``: the scores of negatives for a positive's score of 0 or more, within 64 bits."""

    def share(per_cent: int, up: int) -> str:
        return f"({score} div 100 * {per_cent} + ({score} % 100 * {per_cent} + {up}) div 100)"

    return F.expr(f"named_struct('w', w, 'lo', {share(LEAST, 99)}, 'hi', {share(MOST, 0)})")


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; the contract of ``op12``.

    Every row stands for itself, so a repeated anchor gives its rows again, and rows that repeat an id
    are told apart. A row without an id is no anchor but can be found, last among equal scores. A
    vector that is shorter than another counts as filled up with zeros. Rows that :func:`cleaned` leaves out
    take no part; further columns are ignored.
    """
    blocks = in_blocks(written(cleaned(embeddings), "vectors"))
    size = blocks.agg(
        F.max(F.shiftright("block", 24)).alias("pid"),
        F.max(F.col("block").bitwiseAND(F.lit((1 << 24) - 1))).alias("seq"),
    ).first()
    if size["pid"] is None:
        return embeddings.sparkSession.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
        )
    # Groups follow the curve and have running numbers.
    per_part = size["seq"] // (4 * BUNDLE) + 1
    groups = (size["pid"] // GROUP_PARTS + 1) * per_part
    grp = f"(block >> 24) div {GROUP_PARTS} * {per_part} + (block & {(1 << 24) - 1}) div {4 * BUNDLE}"
    anchors = written(
        blocks.select("block", "dims", "ids", "labels", "q", F.explode("anchors").alias("a")).select(
            F.expr(f"block * {ROWS} + a.pos").alias("akey"),
            F.expr(grp).cast("long").alias("grp"),
            F.expr("ids[a.pos]").alias("anchor_id"),
            F.expr("labels[a.pos]").alias("label"),
            F.expr("substring(q, a.pos * 4 * dims + 1, 4 * dims)").alias("q"),
            F.col("a.floor").alias("floor"),
        ),
        "anchors",
    )
    above = F.array(
        F.struct(F.lit(1).alias("w"), F.col("floor").alias("lo"), F.lit(HIGHEST).alias("hi"))
    )
    positives = written(
        search(anchors.withColumn("windows", above), blocks, groups, True, POSITIVES).select(
            "akey",
            F.col("rank").alias("w"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    windows = (
        positives.where("positive_score >= 0")
        .groupBy("akey")
        .agg(F.collect_list(_window("positive_score")).alias("windows"))
    )
    found = search(anchors.join(windows, "akey"), blocks, groups, False, NEGATIVES).select(
        "akey", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return (
        found.join(positives, ["akey", "w"])
        .join(anchors.select("akey", "anchor_id"), "akey")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
