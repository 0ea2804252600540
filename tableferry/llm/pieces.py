"""Offset-preserving encoding and decoding with a SentencePiece model.

Normalisation replaces, at each place, the longest prefix that the model's compiled character map
holds, and records for each normalised byte the source byte it came from. Pieces are found in the
normalised text, so their ends give the byte span of the source that each piece stands for.

The model never joins over a word mark that follows another character (checked when it is loaded), so
a text is encoded in stretches that begin with the mark, and each worker remembers the stretches.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from tableferry.llm.common import Remembered, no_collection, slices, tidy

MARK = "▁"
MARK_BYTES = MARK.encode("utf-8")
CUT = re.compile(f"(?<=[^{MARK}])(?={MARK})")
#: Characters of text that a worker encodes at a time.
SLICE_CHARS = 250_000
#: Bound of the pieces that a worker remembers; a tenth of them is asked for most of the time.
CACHE_CHARS = 4_000_000

DIGEST = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"
)
SPANS = "doc_id long, ids array<int>, begins array<long>, ends array<long>"


class CharacterMap:
    """The compiled map: a double-array trie of source strings and the text of their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.targets = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest_prefix(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest mapped string at ``start``."""
        units, best = self.units, None
        node = self._offset(units[0])
        for place in range(start, len(text)):
            byte = text[place]
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != byte:  # no such child
                break
            node ^= self._offset(unit)
            if unit & 0x100:  # a mapped string ends here; its leaf holds the target
                best = place + 1 - start, units[node] & 0x7FFFFFFF
        if best is None:
            return None
        length, target = best
        return length, self.targets[target : self.targets.index(b"\0", target)]


class Normalizer:
    """Normalised text, and for each of its bytes (and its end) the source byte."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        if not spec.escape_whitespaces:
            raise ValueError("a model that keeps spaces as they are")

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        raw = text.encode("utf-8")
        if not raw:
            return b"", np.zeros(1, dtype=np.int64)
        if self.map is None and not self.squeeze:
            return self._identity(raw)
        return self._mapped(raw)

    def _identity(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        mark = MARK_BYTES if self.prefix else b""
        codes = np.frombuffer(raw, dtype=np.uint8)
        widths = np.where(codes == 0x20, len(MARK_BYTES), 1)
        places = np.repeat(np.arange(len(raw)), widths)
        source = np.r_[np.zeros(len(mark), dtype=np.int64), places, len(raw)]
        return mark + raw.replace(b" ", MARK_BYTES), source

    def _step(self, raw: bytes, at: int) -> tuple[int, bytes]:
        found = self.map.longest_prefix(raw, at) if self.map else None
        if found:
            return found
        first = raw[at]
        width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return width, raw[at : at + width]

    def _mapped(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        parts: list[bytes] = []
        sources: list[np.ndarray] = []
        at, size = 0, 0
        if self.squeeze:
            while at < len(raw):
                width, made = self._step(raw, at)
                if made != b" ":
                    break
                at += width
            if at == len(raw):
                return b"", np.array([len(raw)])
        if self.prefix:
            parts.append(MARK_BYTES)
            sources.append(np.full(len(MARK_BYTES), at))
        after_space = self.squeeze
        while at < len(raw):
            width, made = self._step(raw, at)
            if self.squeeze and after_space:
                made = made.lstrip(b" ")
            if made:
                after_space = self.squeeze and made.endswith(b" ")
                made = made.replace(b" ", MARK_BYTES)
                parts.append(made)
                sources.append(np.full(len(made), at))
            at += width
        normal, source = b"".join(parts), np.concatenate([*sources, [len(raw)]])
        if self.squeeze:
            while normal.endswith(MARK_BYTES):
                size = len(normal) - len(MARK_BYTES)
                normal, source = normal[:size], source[: size + 1]
        return normal, source


class PieceCodec:
    """Ids and byte spans of texts, and texts of ids."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.end = self.decoder.eos_id()
        self.unknown = self.decoder.unk_id()
        self.normalizer = Normalizer(proto.normalizer_spec)
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: word marks behind words")
        # Normalised text goes into the same model without its normaliser.
        spec = proto.normalizer_spec
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        joins = [p.piece for p in proto.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
        if any(CUT.search(piece) for piece in joins):
            raise ValueError(f"{path}: pieces that go over the end of a word")
        self.widths = np.array(
            [1 if p.type == kinds.BYTE else len(p.piece.encode("utf-8")) for p in proto.pieces],
            dtype=np.int64,
        )
        self.widths[self.end] = 0
        self.may_be_unknown = not any(p.type == kinds.BYTE for p in proto.pieces)
        self.decimals = list(map(str, range(len(proto.pieces))))
        self.known = Remembered(CACHE_CHARS)

    @no_collection()
    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text: its ids, and begin and end of the source bytes that each stands for.

        The end id is last; it stands for no bytes, at the end of the text. A piece that is one byte
        of a character has the span of that byte; a dummy word mark has an empty span.
        """
        normal = [self.normalizer(text) for text in texts]
        cut = [self._stretches(n.decode("utf-8")) for n, _ in normal]
        self._learn(list(self.known.missing(map(set, cut))))
        out = []
        get, end = self.known.young.__getitem__, np.array([self.end], dtype="<i4").tobytes()
        for stretches, (text, source) in zip(cut, normal, strict=True):
            ids = np.frombuffer(b"".join(map(get, stretches)) + end, dtype="<i4")
            bounds = np.zeros(len(ids) + 1, dtype=np.int64)
            np.cumsum(self._widths(ids, text), out=bounds[1:])
            bounds = source[bounds]
            out.append((ids, bounds[:-1], bounds[1:]))
        return out

    def _widths(self, ids: np.ndarray, text: bytes) -> np.ndarray:
        """Bytes of the normalised text in each piece."""
        if self.may_be_unknown and (ids == self.unknown).any():
            pieces = self.encoder.encode(text.decode("utf-8"), return_type="proto").pieces
            return np.array([*(len(p.surface.encode("utf-8")) for p in pieces), 0])
        return self.widths[ids]

    def _stretches(self, normal: str) -> list[str]:
        """The text cut before each mark that follows another character."""
        head, *tail = normal.split(MARK)
        if not head and all(tail):
            return [MARK + piece for piece in tail]
        return CUT.split(normal) if normal else []

    def _learn(self, new: list[str]) -> None:
        found = self.encoder.encode(new, num_threads=1) if new else []
        raw = np.fromiter(chain.from_iterable(found), dtype="<i4").tobytes()
        ends = [4 * n for n in accumulate(map(len, found))]
        begins = [0, *ends]
        self.known.young.update(
            (stretch, raw[a:b]) for stretch, a, b in zip(new, begins, ends, strict=False)
        )

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.decoder.decode(ids, num_threads=1) if ids else []

    def decimal(self, ids: list[int]) -> str:
        """Ids in decimal, joined by spaces."""
        return " ".join(map(self.decimals.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec for each worker and model."""
    return PieceCodec(path)


def encode_spans(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, begins, ends``: pieces with the source bytes each stands for.

    A null or empty text has just the end id. Every row stands for itself; further columns are
    ignored. Map-only.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text").to_pylist(), SLICE_CHARS):
                found = pieces.encode(texts)
                doc_ids = batch.column("doc_id").slice(at, len(texts)).cast(pa.int64())
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        pa.array([f[0] for f in found], pa.list_(pa.int32())),
                        pa.array([f[1] for f in found], pa.list_(pa.int64())),
                        pa.array([f[2] for f in found], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "ids", "begins", "ends"],
                )

    return documents.select("doc_id", "text").mapInArrow(work, SPANS)


def encode_digest(documents: DataFrame, model: str) -> DataFrame:
    """Digests of ids, decoded text and source spans of every document.

    ``ids_sha256`` is over the decimal ids joined by spaces, ``decoded_sha256`` over the decoded text,
    ``spans_crc32`` over the spans' ends as little-endian 64-bit integers. Rows as in
    :func:`encode_spans`.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text").to_pylist(), SLICE_CHARS):
                found = pieces.encode(texts)
                ids = [f[0].tolist() for f in found]
                decoded = pieces.decode(ids)
                doc_ids = batch.column("doc_id").slice(at, len(texts)).cast(pa.int64())
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        pa.array(list(map(len, ids)), pa.int64()),
                        pa.array([sha256(pieces.decimal(i)) for i in ids], pa.string()),
                        pa.array([sha256(text) for text in decoded], pa.string()),
                        pa.array(
                            [zlib.crc32(f[2].astype("<i8").tobytes()) for f in found], pa.int64()
                        ),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
                )
        tidy()

    return documents.select("doc_id", "text").mapInArrow(work, DIGEST)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
