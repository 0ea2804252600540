"""The target schema: table names, folders, publishing.

Every load writes a new folder and registers it as an external table, so publishing, backing up
and restoring a table are catalog renames: their cost does not grow with the table, on any
file system. A folder is deleted only together with the table that points at it.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tableferry.catalog import base_tables
from tableferry.functions.formats import backup_suffix
from tableferry.functions.projection import quote_identifier
from tableferry.storage import delete_folder, is_inside, list_names, same_place

log = logging.getLogger(__name__)

STAGING = "__staging"
BACKUP = "__backup_"
VERSIONS = "__versions"

# Property of a table that a run is about to replace by renaming.
PUBLISHING = "tableferry.publishing"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class SwapError(RuntimeError):
    """Staging could not be published; the previous table is in place again."""


class Target:
    """One schema of the session catalog. ``root`` is the folder for a new schema."""

    def __init__(self, spark: SparkSession, schema: str = "ods", root: str | None = None):
        self.spark = spark
        self.schema = schema
        self.root = root.rstrip("/") if root else None

    def ensure(self) -> Target:
        """Create the schema if it is not there."""
        statement = f"CREATE SCHEMA IF NOT EXISTS {quote_identifier(self.schema)}"
        if self.root:
            folder = f"{self.root}/{self.schema}".replace("'", "\\'")
            statement += f" LOCATION '{folder}'"
        self.spark.sql(statement)
        return self

    def check(self) -> None:
        """Raise if the schema is not there."""
        self.spark.catalog.getDatabase(self.schema)

    @property
    def folder(self) -> str:
        return self.spark.catalog.getDatabase(self.schema).locationUri.rstrip("/")

    def name(self, table: str) -> str:
        return f"{quote_identifier(self.schema)}.{quote_identifier(table.lower())}"

    def check_name(self, table: str) -> None:
        """Raise if the catalog cannot hold a table of this name, or it is kept for another use."""
        if not re.fullmatch(r"\w+", table, re.ASCII):
            raise ValueError(f"not a table name the catalog can hold: {table!r}")
        if table.lower().endswith(STAGING) or BACKUP in table.lower():
            raise ValueError(f"name of a staging or backup table: {table!r}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str):
        return self.spark.table(self.name(table))

    def new_folder(self, table: str) -> str:
        return f"{self.folder}/{VERSIONS}/{table.lower()}/{uuid.uuid4().hex}"

    def describe(self, table: str) -> dict:
        """Catalog entry: type, location, statistics."""
        return json.loads(
            self.spark.sql(f"DESCRIBE EXTENDED {self.name(table)} AS JSON").first()[0]
        )

    def drop(self, table: str) -> None:
        """Drop a table if it exists, with the folder a load wrote for it."""
        if not self.exists(table):
            return
        entry = self.describe(table)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        location = entry.get("location", "")
        if entry.get("type") == "EXTERNAL":
            self._delete_version(table, location)

    def _delete_version(self, table: str, location: str) -> None:
        """Delete the folder of a load unless another table of its family points at it, as
        happens when a run is cut off while it publishes."""
        if not is_inside(location, f"{self.folder}/{VERSIONS}"):
            return
        base = table.lower().removesuffix(STAGING).split(BACKUP)[0]
        family = [base, f"{base}{STAGING}", *self.backups(base)]
        used = [self.describe(name).get("location", "") for name in family if self.exists(name)]
        if not any(same_place(location, other) for other in used):
            delete_folder(self.spark, location)

    def register(self, table: str, folder: str, schema: StructType) -> None:
        """Make the parquet files anywhere below a folder a table."""
        self.spark.catalog.createTable(
            self.name(table), folder, "parquet", schema, recursiveFileLookup="true"
        )

    def rename(self, table: str, new_name: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} RENAME TO {self.name(new_name)}")

    def backups(self, table: str) -> list[str]:
        """Backup tables of a table, oldest first."""
        names = base_tables(self.spark, self.schema, f"{table.lower()}{BACKUP}")
        # yyyymmdd_hhmmss, then a number where several fall in one second
        return sorted(names, key=lambda name: [int(n) for n in re.findall(r"\d+", name.split(BACKUP)[-1])])

    def restore_if_missing(self, table: str) -> bool:
        """Put a backup back when a run was cut off between the two renames, as a mark on it tells;
        a table that was dropped on purpose stays dropped."""
        if self.exists(table):
            self._unmark(table)
            return False
        marked = [backup for backup in self.backups(table) if self._is_marked(backup)]
        if not marked:
            return False
        self.rename(marked[-1], table)
        self._unmark(table)
        log.warning("restored %s from %s", table, marked[-1])
        return True

    def _is_marked(self, table: str) -> bool:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return any(row.key == PUBLISHING for row in rows)

    def _mark(self, table: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('{PUBLISHING}' = 'true')")

    def _unmark(self, table: str) -> None:
        if self._is_marked(table):
            self.spark.sql(f"ALTER TABLE {self.name(table)} UNSET TBLPROPERTIES ('{PUBLISHING}')")

    def drop_orphans(self) -> list[str]:
        """Delete load folders that no table of the schema points at, left by a lost driver.

        Only safe while nobody else loads into this schema. Returns the folders deleted.
        """
        entries = [self.describe(name) for name in base_tables(self.spark, self.schema)]
        used = {entry.get("location", "").rstrip("/").rsplit("/", 1)[-1] for entry in entries}
        versions = f"{self.folder}/{VERSIONS}"
        orphans = [
            f"{versions}/{table}/{name}"
            for table in list_names(self.spark, versions, missing_ok=True)
            for name in list_names(self.spark, f"{versions}/{table}")
            if name not in used
        ]
        for folder in orphans:
            delete_folder(self.spark, folder)
        return orphans

    def swap(self, table: str, moment: datetime, keep_backups: int | None = 0) -> str | None:
        """Publish staging as the final table.

        If both have the same columns and format, the final is pointed at the new folder, by one
        catalog operation: a reader finds the old rows or the new ones. Otherwise it takes two
        renames, between which the table is not there; a mark on the previous final tells the next
        run to undo a publish that was cut off there.

        The previous final becomes ``<table>__backup_<yyyymmdd_hhmmss>``. It is dropped
        (``keep_backups=0``), or the newest ``keep_backups`` backups stay (``None``: all).
        Returns the backup's name if it is kept.
        """
        backup = self._free_backup_name(table, moment) if self.exists(table) else None
        if backup and self._same_form(table, f"{table}{STAGING}"):
            self._move_pointer(table, backup)
        else:
            self._rename_both(table, backup)
        self.spark.catalog.refreshTable(self.name(table))
        if backup is None or keep_backups is None:
            return backup
        unwanted = [backup] if keep_backups == 0 else self.backups(table)[:-keep_backups]
        for old in unwanted:
            try:
                self.drop(old)
            except Exception as error:  # the new table is in place already
                log.warning("backup %s not dropped: %s", old, error)
        return backup if keep_backups else None

    def _same_form(self, table: str, other: str) -> bool:
        """Whether two tables differ in nothing but their rows and where these are stored."""
        if not self.exists(other):
            return False
        entries = [self.describe(name) for name in (table, other)]
        forms = [
            [entry.get(key) for key in ("type", "provider", "columns", "partition_columns", "storage_properties")]
            for entry in entries
        ]
        return forms[0] == forms[1] and entries[0].get("type") == "EXTERNAL"

    def _move_pointer(self, table: str, backup: str) -> None:
        old, new = (self.describe(name)["location"] for name in (table, f"{table}{STAGING}"))
        name = self.name(table)
        self.spark.sql(f"CREATE TABLE {self.name(backup)} LIKE {name} LOCATION {_text(old)}")
        try:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(new)}")
        except Exception as error:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(backup)}")
            raise SwapError(f"could not publish {table}: {error}") from error
        try:
            # An external table: its files stay. The statistics were those of the old rows.
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(f'{table}{STAGING}')}")
            self.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
        except Exception as error:  # the new rows are in place already
            log.warning("%s: published, but not tidied up: %s", table, error)

    def _rename_both(self, table: str, backup: str | None) -> None:
        if backup:
            self._mark(table)
            self.rename(table, backup)
        try:
            self.rename(f"{table}{STAGING}", table)
        except Exception as error:
            if backup:
                self.rename(backup, table)
                self._unmark(table)
            raise SwapError(f"could not publish {table}: {error}") from error
        if backup:
            self._unmark(backup)

    def _free_backup_name(self, table: str, moment: datetime) -> str:
        name = f"{table.lower()}{BACKUP}{backup_suffix(moment)}"
        candidate, n = name, 1
        while self.exists(candidate):
            candidate, n = f"{name}_{n}", n + 1
        return candidate

    def drop_schema(self) -> None:
        """Drop the schema with every table and folder in it."""
        folder = self.folder
        self.spark.sql(f"DROP SCHEMA IF EXISTS {quote_identifier(self.schema)} CASCADE")
        delete_folder(self.spark, folder)
