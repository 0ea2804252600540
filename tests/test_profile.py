import uuid

import pytest

from tableferry import Target, catalog_profile
from tableferry.frames import small_frame
from tableferry.operators.validate import count_stored, stored_row_count
from tableferry.plans import profile as profile_module
from tableferry.plans.profile import (
    NAMES_SCHEMA,
    first_tables,
    list_schemas,
    profile_lines,
    tables_per_schema,
)


@pytest.fixture
def schemas(spark, tmp_path):
    made = []
    for count in (12, 10, 0):
        target = Target(spark, f"p{count:02d}_{uuid.uuid4().hex[:6]}", str(tmp_path)).ensure()
        for i in range(count):
            spark.range(i).coalesce(1).write.saveAsTable(target.name(f"t{i:02d}"))
        made.append(target)
    spark.sql(f"CREATE VIEW {made[0].name('a_view')} AS SELECT 1 AS one")
    yield made
    for target in made:
        target.drop_schema()


def test_profile(spark, schemas):
    names = [t.schema for t in schemas]
    rows = catalog_profile(spark, names).orderBy("schema_name", "rn").collect()
    big = [r for r in rows if r.schema_name == names[0]]
    assert [(r.table_name, r.row_count, r.rn) for r in big] == [(f"t{i:02d}", i, i + 1) for i in range(10)]
    assert {(r.n_tables, r.n_more) for r in big} == {(12, 2)}
    assert {(r.n_tables, r.n_more) for r in rows if r.schema_name == names[1]} == {(10, 0)}
    assert not [r for r in rows if r.schema_name == names[2]]


def test_lines(spark, schemas):
    lines = [r.line for r in profile_lines(catalog_profile(spark, [t.schema for t in schemas])).collect()]
    assert lines[0] == f"✓ {schemas[1].schema}: 10 tables"
    assert lines[1] == "    t00: 0 rows"
    assert lines[11] == f"✓ {schemas[0].schema}: 12 tables"
    assert lines[-1] == "    ... and 2 more tables" and len(lines) == 11 + 12


def test_all_schemas_are_listed(spark, schemas):
    listed = {r.schema_name for r in list_schemas(spark).collect()}
    assert {t.schema for t in schemas} <= listed
    assert {t.schema for t in schemas[:2]} <= {r.schema_name for r in catalog_profile(spark).collect()}


def test_unlistable_schema_is_left_out(spark, schemas):
    rows = catalog_profile(spark, ["no_such_schema", schemas[1].schema]).collect()
    assert {r.schema_name for r in rows} == {schemas[1].schema}


def test_known_counts_are_not_counted_again(spark, schemas, monkeypatch):
    target = schemas[1]
    for i in range(10):
        count_stored(target, f"t{i:02d}")
    assert stored_row_count(target, "t07") == 7
    monkeypatch.setattr(profile_module, "collect_counts", lambda spark, frames: {} if not frames else 1 / 0)
    assert catalog_profile(spark, [target.schema]).count() == 10


def test_counts_per_schema(spark):
    tables = small_frame(spark, [("a", "x"), ("a", "y"), ("b", "z")], NAMES_SCHEMA)
    assert sorted(map(tuple, tables_per_schema(tables).collect())) == [("a", 2), ("b", 1)]
    assert {r.table_name: r.n_more for r in first_tables(tables, 1).collect()} == {"x": 1, "z": 0}
