"""Publishing without a gap, loads in pieces, and what a cut-off run leaves."""

import threading
from datetime import datetime, timedelta, timezone
from functools import partial

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tableferry import FrameSource, SyncOptions, Target
from tableferry.operators import stage
from tableferry.operators.stage import Ledger, load_pieces
from tableferry.operators.target import STAGING
from tableferry.plans.sync import attempt_table
from tableferry.storage import list_names

T1 = datetime(2024, 1, 1, tzinfo=timezone.utc)
T2 = T1 + timedelta(days=1)


def numbers(spark, n, column="id"):
    return FrameSource(spark, {"t": spark.range(n).withColumnRenamed("id", column)})


def load(source, target, ts=T1, **options):
    return attempt_table(source, target, "t", SyncOptions(load_ts=ts, write_attempts=1, **options))


def folders(spark, target):
    return list_names(spark, f"{target.folder}/__versions/t", missing_ok=True)


def test_table_of_the_same_form_is_published_by_one_catalog_operation(spark, target, monkeypatch):
    load(numbers(spark, 3), target)
    monkeypatch.setattr(Target, "rename", lambda *a: pytest.fail("renamed"))
    before = target.describe("t")["location"]
    assert load(numbers(spark, 5), target, T2, keep_backups=1)["status"] == "SUCCESS"
    assert target.read("t").count() == 5 and target.describe("t")["statistics"]["num_rows"] == 5
    (backup,) = target.backups("t")
    assert target.read(backup).count() == 3 and target.describe(backup)["location"] == before
    assert not target.exists(f"t{STAGING}") and len(folders(spark, target)) == 2
    assert load(numbers(spark, 7), target, T2 + timedelta(days=1))["status"] == "SUCCESS"
    assert target.read("t").count() == 7


def test_a_reader_never_misses_the_table(spark, target):
    load(numbers(spark, 1), target)
    ended, seen, errors = threading.Event(), set(), []

    def reader():
        while not ended.is_set():
            try:
                seen.add(target.read("t").count())
            except AnalysisException as error:
                errors.append(error)

    thread = threading.Thread(target=reader)
    thread.start()
    for n in range(2, 8):
        load(numbers(spark, n), target, T1 + timedelta(days=n), keep_backups=None)
    ended.set()
    thread.join()
    assert not errors and seen <= set(range(1, 8))


class Lost(BaseException):
    """The end of a driver: nothing after it runs."""


def cut(monkeypatch, method, after):
    real, calls = getattr(Target, method), []

    def cut_off(self, *args):
        if len(calls) == after:
            raise Lost
        calls.append(args)
        return real(self, *args)

    monkeypatch.setattr(Target, method, cut_off)


def test_publish_cut_off_between_the_renames_is_undone(spark, target, monkeypatch):
    load(numbers(spark, 3), target)
    with monkeypatch.context() as patch, pytest.raises(Lost):
        cut(patch, "rename", 1)
        load(numbers(spark, 5, "other"), target, T2)
    assert not target.exists("t")
    assert target.restore_if_missing("t") and target.read("t").count() == 3
    assert not target._is_marked("t")


def test_table_dropped_on_purpose_stays_dropped(spark, target):
    load(numbers(spark, 3), target)
    load(numbers(spark, 5, "other"), target, T2, keep_backups=None)  # by renames
    load(numbers(spark, 6, "other"), target, T2, keep_backups=None)  # by the pointer
    target.drop("t")
    bad = FrameSource(spark, {"t": spark.range(1).selectExpr("raise_error('down') AS id")})
    assert load(bad, target, T2)["status"] == "ERROR"
    assert not target.exists("t") and len(target.backups("t")) == 2


def test_staging_left_at_the_published_folder_does_not_take_it_along(spark, target):
    load(numbers(spark, 3), target)
    location = target.describe("t")["location"]
    # As a driver leaves it that is lost after the pointer has moved.
    spark.sql(f"CREATE TABLE {target.name('t' + STAGING)} LIKE {target.name('t')} LOCATION '{location}'")
    target.drop(f"t{STAGING}")
    assert target.read("t").count() == 3
    bad = FrameSource(spark, {"t": spark.range(1).selectExpr("raise_error('down') AS id")})
    load(bad, target, T2)
    assert target.read("t").count() == 3


def test_backups_of_one_second_are_ordered_by_number(spark, target):
    for n in range(1, 13):
        load(numbers(spark, n), target, keep_backups=None)
    assert [target.read(b).count() for b in target.backups("t")] == list(range(1, 12))


# --- pieces -------------------------------------------------------------------------------


class Waves(FrameSource):
    """Gives its table in waves, some of which fail the first time."""

    def __init__(self, spark, n, waves, failing=()):
        super().__init__(spark, {"t": spark.range(n)})
        self.n_waves, self.failing, self.opened = waves, set(failing), []

    def waves(self, table):
        def wave(i):
            self.opened.append(i)
            rows = self.frames[table].where(F.col("id") % self.n_waves == i)
            if i in self.failing:
                self.failing.remove(i)
                return rows.where(F.raise_error(F.lit("lost")).isNull())
            return rows

        return [partial(wave, i) for i in range(self.n_waves)]


def test_a_further_attempt_writes_only_what_is_missing(spark, target, monkeypatch):
    monkeypatch.setattr(stage.time, "sleep", lambda s: None)
    source = Waves(spark, 1000, 5, failing=[1, 3])
    result = attempt_table(source, target, "t", SyncOptions(load_ts=T1, write_attempts=3, recount_source=True))
    assert (result["status"], result["rows_loaded"], result["actual_count"]) == ("SUCCESS", 1000, 1000)
    assert source.opened == [0, 1, 1, 2, 3, 3, 4]
    assert target.read("t").select("ID").distinct().count() == 1000
    assert load(Waves(spark, 500, 2), target, T2)["status"] == "SUCCESS"
    assert target.read("t").count() == 500 and len(folders(spark, target)) == 1


def test_a_load_in_pieces_that_fails_leaves_nothing(spark, target):
    result = load(Waves(spark, 10, 3, failing=[2]), target)
    assert result["status"] == "ERROR" and "lost" in result["error"]
    assert folders(spark, target) == [] and not target.exists("t")


def test_a_ledger_outlasts_a_failure(spark, target):
    source = Waves(spark, 90, 3, failing=[2])
    ledger = Ledger(target.new_folder("t"))
    with pytest.raises(Exception, match="lost"):
        load_pieces(source.waves("t"), target, "t", (), None, ledger)
    assert ledger.rows == {0: 30, 1: 30} and ledger.reused == 0
    assert load_pieces(source.waves("t"), target, "t", (), None, ledger) == 90
    assert ledger.reused == 2 and target.read(f"t{STAGING}").count() == 90
    # All pieces are there already: the table is only registered again.
    assert load_pieces(source.waves("t"), target, "t", (), None, Ledger(ledger.folder, dict(ledger.rows))) == 90


def test_empty_pieces(spark, target):
    assert load(Waves(spark, 1, 3), target)["status"] == "SUCCESS"
    assert target.read("t").count() == 1 and load(Waves(spark, 0, 2), target, T2)["rows_loaded"] == 0
