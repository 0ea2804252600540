"""Writing a table into staging."""

from __future__ import annotations

import logging
import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from threading import Thread

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tableferry.operators.target import STAGING, Target
from tableferry.storage import delete_folder

log = logging.getLogger(__name__)

WRITE_OPTIONS = {
    # Committed tasks move their own files, so committing a huge write does not queue up on the
    # driver. A failed write can leave part of its output behind, which is harmless: nothing reads
    # staging before its count is checked, and every attempt has its own folder.
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    # A few connections to a database can carry a table of any size: bound their files.
    "maxRecordsPerFile": "10000000",
}

# How long to wait for the count of a finished write.
OBSERVE_SECONDS = 120.0

# Most seconds before a further attempt of a write.
LONGEST_WAIT = 60.0


def waits_of(attempts: int) -> tuple[float, ...]:
    """Seconds before each attempt of a write but the first: 1, 2, 4 and so on."""
    return tuple(min(2.0**i, LONGEST_WAIT) for i in range(attempts - 1))


# Seconds before the second and the third attempt of a write.
WAITS = waits_of(3)

# SQLSTATE classes 22 (data exception) and 42 (syntax or access rule): trying again cannot help.
_LASTING = re.compile(r"SQLSTATE: (22|42)")


def is_lasting(error: Exception) -> bool:
    """Whether an error comes from the data or the schema rather than from the environment."""
    return isinstance(error, (AnalysisException, ValueError)) or bool(_LASTING.search(str(error)))


def observed_rows(written: Observation, seconds: float | None = None) -> int | None:
    """Rows an observation counted, or ``None`` if they are not known in time.

    The count travels over Spark's event queue, which drops events when a huge job overruns it;
    waiting for a dropped one would never end.
    """
    found: list[int] = []
    waiter = Thread(target=lambda: found.append(written.get["rows"]), daemon=True)
    waiter.start()
    waiter.join(OBSERVE_SECONDS if seconds is None else seconds)
    return found[0] if found else None


def write_staging(
    rows: DataFrame, target: Target, table: str, write_options: dict[str, str] | None = None
) -> int | None:
    """Write rows to a fresh staging table in one map-only job; returns the rows written.

    Each call starts from an empty folder, so a second attempt cannot duplicate rows.
    """
    staging = f"{table}{STAGING}"
    target.drop(staging)
    folder = target.new_folder(table)
    written = Observation()
    try:
        (
            rows.observe(written, F.count(F.lit(1)).alias("rows"))
            .write.format("parquet")
            .options(**{**WRITE_OPTIONS, **(write_options or {})})
            .option("path", folder)
            .mode("overwrite")
            .saveAsTable(target.name(staging))
        )
    except Exception:
        delete_folder(target.spark, folder)
        raise
    return observed_rows(written)


def load_staging(
    rows: DataFrame,
    target: Target,
    table: str,
    waits: Sequence[float] = WAITS,
    write_options: dict[str, str] | None = None,
) -> int | None:
    """:func:`write_staging`, once more after each of ``waits`` (seconds) if the environment failed.

    Returns the rows written; an error names those of the attempts before it. Spark already retries
    single tasks; this covers the failure of the whole write. What an attempt left behind is dropped
    by the next one before it writes.
    """
    return _attempts(lambda: write_staging(rows, target, table, write_options), table, waits)


@dataclass
class Ledger:
    """Pieces of a load that are committed, each a folder of its own below ``folder``.

    ``rows`` holds, by the number of a piece, the rows its files say they hold; ``reused`` how often
    an attempt found a piece there that it did not have to write again.
    """

    folder: str
    rows: dict[int, int] = field(default_factory=dict)
    reused: int = 0

    def piece(self, number: int) -> str:
        return f"{self.folder}/piece_{number:08d}"


def write_pieces(
    waves: Sequence[Callable[[], DataFrame]],
    target: Target,
    table: str,
    ledger: Ledger,
    write_options: dict[str, str] | None = None,
) -> int:
    """Write the waves of a table one after another and register them as one staging table.

    A piece that the ledger holds is not read again. Any other starts from an empty folder, and
    counts once its job is committed; the rows are those of the files that the commit left, so
    nothing here waits for an event.
    """
    spark = target.spark
    staging = f"{table}{STAGING}"
    target.drop(staging)
    schema = None
    for number, wave in enumerate(waves):
        if number in ledger.rows:
            ledger.reused += 1
            continue
        rows = wave()
        schema = rows.schema
        rows.write.options(**{**WRITE_OPTIONS, **(write_options or {})}).mode("overwrite").parquet(
            ledger.piece(number)
        )
        ledger.rows[number] = spark.read.schema(schema).parquet(ledger.piece(number)).count()
    target.register(staging, ledger.folder, schema or waves[0]().schema)
    return sum(ledger.rows[number] for number in range(len(waves)))


def load_pieces(
    waves: Sequence[Callable[[], DataFrame]],
    target: Target,
    table: str,
    waits: Sequence[float] = WAITS,
    write_options: dict[str, str] | None = None,
    ledger: Ledger | None = None,
) -> int:
    """:func:`write_pieces`, once more after each of ``waits`` (seconds) if the environment failed:
    a further attempt writes only what is missing. A ``ledger`` that is given outlasts a failure, so
    that a later call can go on; the folder of one that is not is deleted."""
    kept = ledger or Ledger(target.new_folder(table))
    try:
        return _attempts(
            lambda: write_pieces(waves, target, table, kept, write_options), table, waits
        )
    except Exception:
        if ledger is None:
            delete_folder(target.spark, kept.folder)
        raise


def _attempts(write: Callable[[], int | None], table: str, waits: Sequence[float]) -> int | None:
    failed: list[str] = []
    pauses = iter(waits)
    while True:
        try:
            return write()
        except Exception as error:
            pause = None if is_lasting(error) else next(pauses, None)
            if pause is None:
                if failed:
                    error.add_note(f"earlier attempts: {failed}")
                raise
            failed.append(f"{type(error).__name__}: {error}")
        log.warning("%s: write failed, once more in %s s: %s", table, pause, failed[-1])
        time.sleep(pause)
