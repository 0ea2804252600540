"""Reading tables and keeping intermediate results in the shared folder."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tableferry
from tableferry.session import shared_root
from tableferry.storage import delete_folder

#: So many ids (8 bytes each) may be broadcast.
BROADCAST_IDS = 1_000_000
#: Bound of each of the two halves of :class:`Remembered`: characters, and so many for each piece.
CACHE_CHARS, PIECE_CHARS = 24_000_000, 50
#: Bytes of a batch of rows on its way to a Python worker.
BATCH_BYTES = 4 << 20
_folders: dict[str, SparkSession] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, and batches of bounded size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(tableferry.__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="tableferry-"), "tableferry-llm.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, Path(root.name) / file.relative_to(root))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach; it goes when the driver ends."""
    folder = f"{shared_root(spark)}/tableferry-llm/{purpose}-{uuid.uuid4().hex}"
    _folders[folder] = spark
    return folder


def written(frame: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The frame as a written table: computed once, and safe against lost executors. ``options`` of the write."""
    spark = frame.sparkSession
    path = new_folder(spark, purpose)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop(frame: DataFrame) -> None:
    """Delete the files of a :func:`written` frame that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        if "/tableferry-llm/" in folder:
            delete_folder(frame.sparkSession, folder)


def slices(texts: Iterable[str | None], limit: int) -> Iterator[list[str]]:
    """Runs of texts (null as empty) with about ``limit`` characters; a longer text is a run of its own."""
    run: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if run and size + len(text) > limit:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def tidy() -> None:
    """Give free memory back at the end of a task: its worker waits for others beside the next stages."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


@contextmanager
def no_collection() -> Iterator[None]:
    """Without Python's search for cycles, which walks long lists of pieces again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Remembered:
    """What a worker has worked out for pieces of text.

    ``young`` holds what was asked for of late, and an older half what was asked for before; when the
    young half is full it becomes the old one. Bounded by characters, so that long pieces are soon gone.
    """

    def __init__(self, limit: int = CACHE_CHARS):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0

    def missing(self, wanted: Iterable[set[str]]) -> set[str]:
        """The pieces that have to be worked out and put into ``young``; all others are in it now."""
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, 0
        new: set[str] = set()
        for pieces in wanted:
            new.update(pieces.difference(self.young))
        self.size += sum(map(len, new)) + PIECE_CHARS * len(new)
        known = new & self.old.keys()
        self.young.update((piece, self.old[piece]) for piece in known)
        return new - known


def light(ids: DataFrame) -> DataFrame:
    """The ids (one column), marked for a broadcast up to a checked number.

    What Spark estimates of a written table is the size of its files, whatever is left of their rows.
    """
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def without(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose ``doc_id`` is not among ``ids`` (one long column); null ids stay.

    Ids up to a checked number are broadcast; more of them meet the documents in a shuffle.
    """
    ids = light(ids.toDF("dropped").where("dropped IS NOT NULL").distinct())
    return documents.join(ids, documents["doc_id"].cast("long") == ids["dropped"], "left_anti")


@atexit.register
def _clean() -> None:
    while _folders:
        folder, spark = _folders.popitem()
        with suppress(Exception):  # the session may have ended
            delete_folder(spark, folder)
