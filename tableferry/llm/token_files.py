"""Token ids as Arrow stream files of equal-length sequences and masks.

A file holds the ids of a run of documents in ascending order of ``doc_id``, packed end to end into
sequences of one length; the last is filled up with zeros that its mask marks. Ids and masks are
fixed-size lists in record batches of equal size, uncompressed, so a mapped file gives any sequence
without a copy. A second stream file beside it lists the documents and their numbers of ids.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tableferry.llm.common import Remembered, no_collection, slices, table

#: Characters of text that a worker splits at a time.
SLICE_CHARS = 2_000_000
SEQUENCE = 2048
#: Sequences in a record batch.
ROWS = 128

MANIFEST = "file string, first_doc_id long, n_docs long, n_tokens long"
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


#: A run of letters and ASCII marks behind it, without the apostrophe, which can begin a token.
LETTERS_AND_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")


class Encoder:
    """Ids of texts, as bytes of the smallest unsigned type that holds the vocabulary.

    Text is cut at spaces and line ends, which the tokenizer drops and never joins over, and the ids
    of a piece are remembered. A new piece of letters and marks is cut once more between the two, where a
    pre-token always ends; new words are encoded together and told apart by their last tokens.
    """

    def __init__(self, path: str, end_id: int):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(names.values())
        self.dtype = np.dtype("<u2") if max(size, end_id) < 1 << 16 else np.dtype("<u4")
        self.end = np.array([end_id], dtype=self.dtype).tobytes()
        self.known = Remembered()
        self.words = Remembered()
        self.ends_word = np.zeros(size + 1, dtype=bool)
        self.ends_word[[i for name, i in names.items() if name.endswith("</w>")]] = True
        if self._ids("A b,! c") != [i for t in ("a", "b", ",!", "c") for i in self._ids(t)]:
            raise ValueError(f"{path}: not words in lower case, cut at spaces and marks")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, text: str) -> bytes:
        return np.array(self._ids(text), dtype=self.dtype).tobytes()

    @no_collection()
    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with the end id."""
        cut = [text.replace("\n", " ").split(" ") for text in texts]
        self._learn(self.known.missing(map(set, cut)))
        get = self.known.young.__getitem__
        return [b"".join(map(get, pieces)) + self.end for pieces in cut]

    def _learn(self, new: set[str]) -> None:
        known = self.known.young
        # Letters alone and letters with marks behind, each with its words; the rest goes as it is.
        plain = [piece for piece in new if piece.isalpha()]
        bare = [piece.lower() if piece.isascii() else piece for piece in plain]
        marked, parts = [], []
        for piece in new.difference(plain):
            match = LETTERS_AND_MARKS.fullmatch(piece)
            if match and match[1].isalpha():
                marked.append(piece)
                parts.append((match[1].lower() if match[1].isascii() else match[1], match[2]))
            else:
                known[piece] = self._bytes(piece)
        marks = {m for _, m in parts}
        new_words = self.words.missing([set(bare), {w for w, _ in parts}, marks])
        self._learn_words(list(new_words - marks))
        words = self.words.young
        words.update((mark, self._bytes(mark)) for mark in new_words & marks)
        known.update(zip(plain, map(words.__getitem__, bare), strict=True))
        known.update(zip(marked, [words[word] + words[end] for word, end in parts], strict=True))

    def _learn_words(self, new: list[str]) -> None:
        for at in range(0, len(new), 2000):
            some = new[at : at + 2000]
            joined = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(joined[0].ids, dtype=self.dtype)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):  # a letter that the library does not count as one
                self.words.young.update((word, self._bytes(word)) for word in some)
                continue
            raw, bounds = ids.tobytes(), [0, *(ends * self.dtype.itemsize).tolist()]
            self.words.young.update(
                (word, raw[a:b]) for word, a, b in zip(some, bounds, bounds[1:], strict=False)
            )


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    """One encoder for each worker and vocabulary."""
    return Encoder(path, end_id)


def file_system(location: str) -> tuple[pafs.FileSystem, str]:
    """Any store that Arrow can reach: local paths, ``file:``, ``hdfs:``, ``s3:``, ``gs:``."""
    if location.startswith("file:"):
        location = "/" + location.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(location)


class StreamWriter:
    """One file of sequences and its index; they appear under their names when complete."""

    def __init__(self, folder: str, dtype: np.dtype, length: int):
        self.store, self.folder = file_system(folder)
        self.store.create_dir(self.folder, recursive=True)
        self.dtype, self.length = dtype, length
        self.temporary = f"{self.folder}/.{uuid4().hex}"
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema(
            [("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))]
        )
        self.sink = self.store.open_output_stream(f"{self.temporary}.ids")
        self.stream = pa.ipc.new_stream(self.sink, self.schema)
        self.waiting: list[bytes] = []
        self.size = 0
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_ids: list[int | None], encoded: list[bytes]) -> None:
        width = self.dtype.itemsize
        for doc_id, ids in zip(doc_ids, encoded, strict=True):
            self.doc_ids.append(doc_id)
            self.lengths.append(len(ids) // width)
            self.waiting.append(ids)
            self.size += len(ids)
        full = self.length * ROWS * width
        if self.size >= full:
            raw = b"".join(self.waiting)
            whole = len(raw) // full * full
            for at in range(0, whole, full):
                self._batch(raw[at : at + full], self.length * ROWS)
            self.waiting, self.size = [raw[whole:]], len(raw) - whole

    def _batch(self, raw: bytes, tokens: int) -> None:
        rows = -(-tokens // self.length)
        ids = np.zeros(rows * self.length, dtype=self.dtype)
        ids[:tokens] = np.frombuffer(raw, dtype=self.dtype)
        mask = np.arange(rows * self.length) < tokens
        arrays = [pa.array(ids), pa.array(mask)]
        self.stream.write_batch(
            pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(a, self.length) for a in arrays],
                schema=self.schema,
            )
        )

    def close(self, name: str) -> dict:
        rest = b"".join(self.waiting)
        if rest:
            self._batch(rest, len(rest) // self.dtype.itemsize)
        self.stream.close()
        self.sink.close()
        index = pa.table(
            {
                "doc_id": pa.array(self.doc_ids, pa.int64()),
                "n_tokens": pa.array(self.lengths, pa.int64()),
            }
        )
        with self.store.open_output_stream(f"{self.temporary}.docs") as sink:
            with pa.ipc.new_stream(sink, index.schema) as stream:
                stream.write_table(index)
        self.store.move(f"{self.temporary}.docs", f"{self.folder}/{name}.docs.arrows")
        self.store.move(f"{self.temporary}.ids", f"{self.folder}/{name}.ids.arrows")
        return {
            "file": name,
            "first_doc_id": self.doc_ids[0],
            "n_docs": len(self.doc_ids),
            "n_tokens": sum(self.lengths),
        }


def write_token_files(
    documents: DataFrame, folder: str, vocabulary: str, end_id: int = 1, length: int = SEQUENCE
) -> DataFrame:
    """Write the ids of all documents; returns the manifest, one row per file.

    Documents are dealt by ranges of ``doc_id``, so files follow each other in that order (null ids
    first, repeated ids by text). A null or empty text has just the end id. A task that runs again
    writes the same content under the same names.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary, end_id)
        writer = None
        first: int | None = None
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            at = 0
            for texts in slices(batch.column("text").to_pylist(), SLICE_CHARS):
                if writer is None:
                    writer, first = StreamWriter(folder, tokens.dtype, length), doc_ids[0]
                writer.add(doc_ids[at : at + len(texts)], tokens.encode(texts))
                at += len(texts)
        if writer is not None:
            row = writer.close("null" if first is None else f"{first:+020d}")
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema(
        [("file", pa.string()), *((n, pa.int64()) for n in ("first_doc_id", "n_docs", "n_tokens"))]
    )
    spark = documents.sparkSession
    dealt = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id"))
        .sortWithinPartitions("doc_id", "text")
    )
    manifest = f"{folder}/manifest"
    dealt.mapInArrow(work, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def open_sequences(folder: str, name: str) -> pa.Table:
    """The sequences of a file; on a local file system its pages are mapped, not read."""
    store, path = file_system(folder)
    path = f"{path}/{name}.ids.arrows"
    if isinstance(store, pafs.LocalFileSystem):
        return pa.ipc.open_stream(pa.memory_map(path)).read_all()
    with store.open_input_file(path) as source:
        return pa.ipc.open_stream(source).read_all()


def sequence(sequences: pa.Table, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (a view of the file) and mask of one sequence; batches are of equal size."""
    rows = sequences.column("ids").chunk(0).__len__()
    chunk, place = divmod(at, rows)
    ids = sequences.column("ids").chunk(chunk)
    mask = sequences.column("mask").chunk(chunk)
    return (
        ids.slice(place, 1).flatten().to_numpy(),
        mask.slice(place, 1).flatten().to_numpy(zero_copy_only=False),
    )


def read_documents(folder: str, name: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``doc_id``, start in the file and ids of each document of a file."""
    store, path = file_system(folder)
    with store.open_input_file(f"{path}/{name}.docs.arrows") as source:
        index = pa.ipc.open_stream(source).read_all()
    sequences = open_sequences(folder, name)
    chunks = [c.flatten().to_numpy() for c in sequences.column("ids").chunks]
    real = sum(c.flatten().true_count for c in sequences.column("mask").chunks)
    if real != sum(index.column("n_tokens").to_pylist()):
        raise ValueError(f"{name}: masks and index differ")
    size = len(chunks[0])
    start = 0
    for doc_id, count in zip(
        index.column("doc_id").to_pylist(), index.column("n_tokens").to_pylist(), strict=True
    ):
        parts, at, left = [], start, count
        while left:
            chunk, place = divmod(at, size)
            part = chunks[chunk][place : place + left]
            parts.append(part)
            at, left = at + len(part), left - len(part)
        ids = parts[0] if len(parts) == 1 else np.concatenate(parts or [chunks[0][:0]])
        yield doc_id, start, ids
        start += count


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it. One task reads one file at a time; only the
    sizes of the files are summed in one place.
    """
    order = Window.orderBy(F.col("first_doc_id").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    files = manifest.select(
        "file", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("before")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = [
                    (d, row["before"] + s, len(i), zlib.crc32(i.astype("<u4").tobytes()))
                    for d, s, i in read_documents(folder, row["file"])
                ]
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # As many tasks as files: their rows are tiny, so Spark would put them into one task.
    return files.repartition(max(1, manifest.count())).mapInArrow(work, SCHEMA)


def token_files(
    spark: SparkSession, sf_dir: str, folder: str, vocabulary: str, end_id: int = 1
) -> DataFrame:
    """Encode ``documents``, write the files and read them back."""
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary, end_id)
    return read_token_files(spark, folder, manifest)
