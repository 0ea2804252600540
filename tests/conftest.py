import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableferry import Target, build_session  # noqa: E402
from tableferry.registry.workspace import drop_workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(base / "warehouse"),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    drop_workspace()
    session.stop()


@pytest.fixture
def target(spark, tmp_path):
    made = Target(spark, f"ods_{uuid.uuid4().hex[:8]}", str(tmp_path)).ensure()
    yield made
    if spark.catalog.databaseExists(made.schema):
        made.drop_schema()
