"""Target schemas for the registered queries, under the shared folder of the cluster."""

from __future__ import annotations

import atexit
import hashlib
import re
import uuid
from contextlib import suppress

from pyspark.sql import SparkSession

from tableferry.operators.target import Target
from tableferry.session import shared_root
from tableferry.storage import delete_folder

_targets: list[Target] = []
_roots: dict[str, SparkSession] = {}


def _application_root(spark: SparkSession) -> str:
    application = re.sub(r"\W+", "_", spark.sparkContext.applicationId).lower()
    root = f"{shared_root(spark)}/tableferry/{application}"
    _roots[root] = spark
    return root


def workspace_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder of this application; it goes when the application ends."""
    return f"{_application_root(spark)}/{purpose}_{uuid.uuid4().hex}"


def workspace_target(spark: SparkSession, purpose: str, sf_dir: str) -> Target:
    """A schema of this application for one purpose and data folder.

    Running a query again refreshes the same tables, so storage does not grow with runs.
    """
    root = _application_root(spark)
    application = root.rsplit("/", 1)[1]
    data = hashlib.md5(str(sf_dir).encode()).hexdigest()[:8]
    target = Target(spark, f"ods_{purpose}_{data}_{application}", root).ensure()
    _targets.append(target)
    return target


@atexit.register
def drop_workspace() -> None:
    """Drop every schema handed out here, as far as its session is still running."""
    with suppress(Exception):  # the session may have ended
        while _targets:
            target = _targets.pop()
            if target.spark.catalog.databaseExists(target.schema):
                target.drop_schema()
        while _roots:
            root, spark = _roots.popitem()
            delete_folder(spark, root)
