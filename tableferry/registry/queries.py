"""The registered queries: each runs an operator over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.projection import LOAD_STAMP, ProjectionOptions, hex_text
from tableferry.functions.rowhash import utc_moment, with_row_hash
from tableferry.functions.types import with_target_types
from tableferry.operators.audit import AUDIT_TABLE, duplicate_audit_keys
from tableferry.operators.changes import apply_changes, change_sets
from tableferry.operators.checksum import Fingerprint, checksums, differing_rows
from tableferry.operators.counts import count_tables
from tableferry.operators.messages import message_head, purge_counts, select_purgeable
from tableferry.operators.stage import Ledger, load_pieces
from tableferry.operators.target import Target
from tableferry.operators.validate import check_json_types, target_column_catalog
from tableferry.plans.increment import LOAD_ID, Cursor, sync_increment
from tableferry.plans.profile import catalog_profile, list_base_tables, profile_lines, tables_per_schema
from tableferry.plans.reconcile import mismatch_lines, reconcile, reconcile_lines, total_line
from tableferry.plans.report import failed, succeeded
from tableferry.plans.sync import SyncOptions, SyncRun, sync_all, sync_table
from tableferry.registry.workspace import workspace_folder, workspace_target
from tableferry.sources import (
    FrameSource,
    ParquetSource,
    Source,
    count_rows,
    discover_tables,
    open_counts,
    table_names,
)

Query = Callable[[SparkSession, str], DataFrame]

LOAD_TS = datetime(2024, 1, 1, tzinfo=timezone.utc)
LATER_TS = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
EXCLUDED = ("benchmark", "labels")
JSON_COLUMNS = {"events": {"props": "jsonb"}}
PHRASES = ("The ", "And ", "Of,")
REPORT_TITLE = "Nightly copy"
REPORT_SECONDS = 125.9

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def folder(spark: SparkSession, sf_dir: str, types=JSON_COLUMNS) -> ParquetSource:
    return ParquetSource(spark, sf_dir, types=types)


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(LOAD_STAMP, utc_moment(F.col(LOAD_STAMP)))


def load_one(
    source, target: Target, table: str, load_ts: datetime = LOAD_TS, **options
) -> dict:
    return sync_table(source, target, table, options=SyncOptions(load_ts=load_ts, **options))


def load_ok(source, target: Target, table: str, load_ts: datetime = LOAD_TS, **options) -> DataFrame:
    """Load a table and read it back; a load that fails is an error of the query."""
    result = load_one(source, target, table, load_ts, **options)
    if result["status"] != "SUCCESS":
        raise RuntimeError(f"{table}: {result['status']}: {result['error']}")
    return stamped(target.read(table))


# A run is made once per application and data folder; every query that looks at its outcome
# shares it.
_runs: dict[tuple[str, str, str], tuple[SyncRun, Target]] = {}


def shared_run(
    spark: SparkSession, purpose: str, sf_dir: str, source: Source, **options
) -> tuple[SyncRun, Target]:
    key = (spark.sparkContext.applicationId, purpose, sf_dir)
    if key not in _runs:
        target = workspace_target(spark, purpose, sf_dir)
        run = sync_all(source, target, SyncOptions(workers=4, load_ts=LOAD_TS, **options))
        if run.critical_error:
            raise RuntimeError(run.critical_error)
        _runs[key] = run, target
    return _runs[key]


def full_run(spark: SparkSession, sf_dir: str) -> tuple[SyncRun, Target]:
    return shared_run(spark, "full", sf_dir, folder(spark, sf_dir), exclude=EXCLUDED)


# --- discovery ------------------------------------------------------------------------------


def discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = folder(spark, sf_dir)
    found = discover_tables(source, EXCLUDED)
    counts = count_tables(spark, open_counts(source, [row.table_name for row in found.collect()]))
    return found.join(counts, "table_name")


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = folder(spark, sf_dir)
    return count_tables(spark, open_counts(source, table_names(source, base_tables_only=True)))


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source columns with their mapped type, beside what a finished run stored."""
    run, target = full_run(spark, sf_dir)
    names = [result["table"] for result in run.results]
    catalog = with_target_types(folder(spark, sf_dir).column_catalog(names))
    stored = None
    for name in names:
        part = target_column_catalog(target, name).withColumn("table_name", F.lit(name))
        stored = part if stored is None else stored.unionAll(part)
    stored = stored.select(
        "table_name",
        F.lower("column_name").alias("column_name"),
        F.col("data_type").alias("stored_type"),
    )
    return catalog.join(stored, ["table_name", "column_name"], "left").orderBy("table_name", "ordinal")


# --- single loads ---------------------------------------------------------------------------


def load(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = workspace_target(spark, f"load_{table}", sf_dir)
        return load_ok(folder(spark, sf_dir), target, table)

    return query


def load_events_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = workspace_target(spark, "load_events", sf_dir)
    rows = load_ok(folder(spark, sf_dir), target, "events")
    return rows.withColumn("PROPS", F.to_json("PROPS"))


def load_embeddings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list has no mapped type: it lands as text, read back here one element per row."""
    target = workspace_target(spark, "load_embeddings", sf_dir)
    rows = load_ok(folder(spark, sf_dir), target, "embeddings")
    values = F.from_json("EMBEDDING", "array<float>")
    return rows.select("VEC_ID", "LABEL", F.posexplode(values).alias("POS", "VALUE")).withColumn(
        "VALUE", F.col("VALUE").cast("double")
    )


def variant_path_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = workspace_target(spark, "variant_path", sf_dir)
    rows = load_ok(folder(spark, sf_dir), target, "events")
    return rows.groupBy("EVENT_TYPE").agg(
        F.count(F.lit(1)).alias("N_EVENTS"),
        F.sum(F.variant_get("PROPS", "$.k", "bigint")).alias("SUM_K"),
    )


def binary_hex_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as bytes, sent as hex text, stored as binary."""
    documents = folder(spark, sf_dir).read("documents")
    sent = documents.select("doc_id", hex_text(F.col("text").cast("binary")).alias("body"))
    source = FrameSource(spark, {"documents": sent}, types={"documents": {"body": "bytea"}})
    target = workspace_target(spark, "binary", sf_dir)
    rows = load_ok(source, target, "documents")
    return rows.select(
        "DOC_ID", hex_text(F.col("BODY")).alias("BODY_HEX"), F.octet_length("BODY").alias("N_BYTES")
    )


def lenient_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose declared as JSON, stored leniently: what does not parse is NULL."""
    source = folder(spark, sf_dir, {"conversations": {"text": "json"}})
    target = workspace_target(spark, "lenient_json", sf_dir)
    projection = ProjectionOptions(on_bad_json="null")
    rows = load_ok(source, target, "conversations", projection=projection)
    return rows.select("CONV_ID", "TURN", F.col("TEXT").isNotNull().alias("HAS_JSON"))


# --- publishing -----------------------------------------------------------------------------


def parties(spark: SparkSession, sf_dir: str) -> tuple[FrameSource, FrameSource]:
    """Two states of one source table: other rows, and another column."""
    tables = folder(spark, sf_dir)
    first = tables.read("customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    second = tables.read("supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return FrameSource(spark, {"party": first}), FrameSource(spark, {"party": second})


def swap_publishes_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = workspace_target(spark, "swap", sf_dir)
    first, second = parties(spark, sf_dir)
    load_ok(first, target, "party")
    return load_ok(second, target, "party", LATER_TS)


def backup_keeps_old_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = workspace_target(spark, "backup", sf_dir)
    first, second = parties(spark, sf_dir)
    load_ok(first, target, "party")
    load_ok(second, target, "party", LATER_TS, keep_backups=1)
    return stamped(target.read(target.backups("party")[-1]))


def pointer_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of a table, then all of it in the same form: the final and its backup side by side."""
    target = workspace_target(spark, "pointer", sf_dir)
    orders = folder(spark, sf_dir).read("orders")
    half = orders.where(F.col("o_orderkey") % 2 == 0)
    load_ok(FrameSource(spark, {"orders": half}), target, "orders")
    load_ok(FrameSource(spark, {"orders": orders}), target, "orders", LATER_TS, keep_backups=1)
    versions = {"final": "orders", "backup": target.backups("orders")[-1]}
    final, backup = (
        stamped(target.read(name)).withColumn("VERSION", F.lit(version))
        for version, name in versions.items()
    )
    return final.unionAll(backup)


PIECES = 4


def resumed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load in pieces whose third one fails, and the load that goes on from there."""
    target = workspace_target(spark, "resumed", sf_dir)
    rows = folder(spark, sf_dir).read("lineitem")
    number = F.coalesce(F.pmod("l_orderkey", F.lit(PIECES)), F.lit(0))
    waves = [partial(rows.where, number == i) for i in range(PIECES)]
    lost = [*waves]
    lost[2] = partial(rows.where, F.raise_error(F.lit("connection lost")).isNull())
    ledger = Ledger(target.new_folder("lineitem"))
    try:
        load_pieces(lost, target, "lineitem", waits=(), ledger=ledger)
    except Exception as error:
        if "connection lost" not in str(error):
            raise
    load_pieces(waves, target, "lineitem", ledger=ledger)
    target.swap("lineitem", LOAD_TS)
    stored = target.read("lineitem").withColumn("path", F.col("_metadata.file_path"))
    return stored.groupBy(F.regexp_extract("path", r"piece_(\d+)", 1).cast("int").alias("piece")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("l_quantity").alias("sum_quantity"),
        F.lit(ledger.reused).cast("bigint").alias("reused"),
    )


def failed_validation_keeps_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load stores JSON as text, fails validation, and changes nothing."""
    target = workspace_target(spark, "keeps_final", sf_dir)
    source = folder(spark, sf_dir)
    load_ok(source, target, "events")
    as_text = ProjectionOptions(json_as="text")
    result = load_one(source, target, "events", LATER_TS, projection=as_text)
    rows = stamped(target.read("events")).withColumn("PROPS", F.to_json("PROPS"))
    return rows.withColumn("SECOND_LOAD", F.lit(result["status"]))


def malformed_json_is_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed JSON fails its table only, and the previous rows stay."""
    target = workspace_target(spark, "malformed", sf_dir)
    load_ok(folder(spark, sf_dir), target, "documents")
    source = folder(spark, sf_dir, {"documents": {"text": "jsonb"}})
    result = load_one(source, target, "documents", LATER_TS)
    rows = stamped(target.read("documents"))
    return rows.groupBy(LOAD_STAMP).agg(
        F.count(F.lit(1)).alias("N_ROWS"),
        F.sum("N_CHARS").alias("SUM_CHARS"),
        F.lit(result["status"]).alias("SECOND_LOAD"),
    )


# --- a whole run ----------------------------------------------------------------------------


def sync_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, _ = full_run(spark, sf_dir)
    return succeeded(run.results_frame).drop("error")


def validate_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counts of a finished run against the counts the run expected."""
    run, target = full_run(spark, sf_dir)
    stored = count_tables(spark, {r["table"]: count_rows(target.read(r["table"])) for r in run.results})
    expected = run.results_frame.select(F.col("table").alias("table_name"), "expected_count")
    return expected.join(stored, "table_name", "left").select(
        "table_name",
        "expected_count",
        F.col("row_count").alias("actual_count"),
        F.col("expected_count").eqNullSafe(F.col("row_count")).alias("ok"),
    )


def validate_json_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON column of events, in the finished run and in one that never had it."""
    _, target = full_run(spark, sf_dir)
    wanted = folder(spark, sf_dir).columns("events")
    good = check_json_types(spark, "events", wanted, target_column_catalog(target, "events"))
    missing = check_json_types(spark, "orders", wanted, target_column_catalog(target, "orders"))
    return good.unionAll(missing)


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = full_run(spark, sf_dir)
    audit = target.read(AUDIT_TABLE)
    for name in ("LOAD_START", "LOAD_END", "LOADED_AT_UTC"):
        audit = audit.withColumn(name, utc_moment(F.col(name)))
    unset = F.col("LAST_SOURCE_ID").isNull() & F.col("ROW_HASH").isNull()
    clean = F.col("ERROR_MESSAGE").isNull()
    return audit.withColumn("UNSET", unset & clean).drop("LAST_SOURCE_ID", "ROW_HASH", "ERROR_MESSAGE")


def audit_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of audit rows and of duplicated keys."""
    _, target = full_run(spark, sf_dir)
    audit = target.read(AUDIT_TABLE)
    duplicates = duplicate_audit_keys(audit).agg(F.count(F.lit(1)).alias("n"))
    rows = audit.agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.lit("rows").alias("what"), "n").unionAll(
        duplicates.select(F.lit("duplicate keys").alias("what"), "n")
    )


def flat_summary(summary: DataFrame) -> DataFrame:
    pairs = F.transform("failed_tables", lambda f: F.concat(f.table, F.lit(": "), f.error))
    return summary.withColumn("failed_tables", F.array_join(pairs, "; "))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, _ = full_run(spark, sf_dir)
    return flat_summary(run.summary(duration=REPORT_SECONDS))


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, _ = full_run(spark, sf_dir)
    return run.report(REPORT_TITLE, LOAD_TS, REPORT_SECONDS)


def failing_run(spark: SparkSession, sf_dir: str) -> SyncRun:
    """A run in which one of its tables stores JSON as text and so fails validation."""
    loaded = ("customer", "events", "orders", "supplier")
    run, _ = shared_run(
        spark,
        "failing",
        sf_dir,
        folder(spark, sf_dir),
        exclude=[table for table in TABLES if table not in loaded],
        projection=ProjectionOptions(json_as="text"),
    )
    return run


def failing_run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = failing_run(spark, sf_dir).results_frame
    return results.withColumn("error", F.coalesce("error", F.lit("")))


def failing_run_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed(failing_run(spark, sf_dir).results_frame)


def failing_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_summary(failing_run(spark, sf_dir).summary(duration=REPORT_SECONDS))


def failing_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failing_run(spark, sf_dir).report(REPORT_TITLE, LOAD_TS, REPORT_SECONDS)


# --- reconciliation and profile -------------------------------------------------------------


def stale_target(spark: SparkSession, sf_dir: str) -> Target:
    """A target that was last refreshed before the newest orders came in."""
    source = folder(spark, sf_dir)
    older = source.read("orders").filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    frames = {name: source.read(name) for name in ("customer", "events", "nation", "region")}
    past = FrameSource(spark, {**frames, "orders": older}, types=JSON_COLUMNS)
    _, target = shared_run(spark, "stale", sf_dir, past)
    return target


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    details, _ = reconcile(folder(spark, sf_dir), stale_target(spark, sf_dir))
    return details.withColumn("target_count", F.coalesce("target_count", F.lit(-1)))


def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, totals = reconcile(folder(spark, sf_dir), stale_target(spark, sf_dir))
    return totals


def reconcile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    details, totals = reconcile(folder(spark, sf_dir), stale_target(spark, sf_dir))
    lines = reconcile_lines(details).unionAll(mismatch_lines(details)).select("line")
    return lines.unionAll(total_line(totals))


def reconcile_synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finished run against its source: only the excluded tables are missing."""
    _, target = full_run(spark, sf_dir)
    details, _ = reconcile(folder(spark, sf_dir), target)
    return details.select("table_name", "source_count", "is_mismatch", "diff", "target_missing")


def profile_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = full_run(spark, sf_dir)
    # The schema's name carries the application; it is shown under a plain one.
    return catalog_profile(spark, [target.schema]).withColumn("schema_name", F.lit("ods"))


def catalog_profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_lines(profile_full(spark, sf_dir)).select("position", "line")


def schema_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = full_run(spark, sf_dir)
    counted = tables_per_schema(list_base_tables(spark, [target.schema]))
    return counted.withColumn("schema_name", F.lit("ods"))


# --- row hash and messages ------------------------------------------------------------------


def row_hash(table: str, *key: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = folder(spark, sf_dir)
        wanted = source.columns(table)
        return with_row_hash(source.read(table), wanted).select(*key, "ROW_HASH")

    return query


def purge_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = folder(spark, sf_dir).read("conversations")
    return select_purgeable(messages, PHRASES).select(
        "conv_id", "turn", message_head(F.col("text")).alias("head")
    )


def purge_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purge_counts(folder(spark, sf_dir).read("conversations"), PHRASES)


# --- changes, checksums, increments -----------------------------------------------------------


def order_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the orders: of the older one rows are missing, altered, repeated and too many;
    in both some have no key."""
    key = F.when(F.col("o_orderkey") % 50 != 8, F.col("o_orderkey")).alias("k")
    rest = ("o_custkey", "o_totalprice", "o_orderpriority")
    orders = folder(spark, sf_dir).read("orders")
    number = F.col("o_orderkey")
    altered = orders.where(number % 10 != 3).withColumns(
        {
            "o_totalprice": F.when(number % 10 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "o_orderpriority": F.when(
                (number % 50 == 8) & (F.col("o_custkey") % 2 == 0), F.lit("none")
            ).otherwise(F.col("o_orderpriority")),
        }
    )
    gone = orders.where(number % 10 == 7).withColumn("o_orderkey", number + 1_000_000_000)
    parts = (altered, orders.where(number % 25 == 0), gone)
    old = parts[0].select(key, *rest)
    for part in parts[1:]:
        old = old.unionAll(part.select(key, *rest))
    return old, orders.select(key, *rest)


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = change_sets(*order_versions(spark, sf_dir), ["k"])
    return changes.select("op", F.col("copies").cast("bigint").alias("copies"), "row.*")


def order_changes_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older version with the changes applied is the newer one."""
    old, new = order_versions(spark, sf_dir)
    return apply_changes(old, change_sets(old, new, ["k"]))


def table_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checksums(folder(spark, sf_dir), TABLES)


def altered_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three altered rows among as many rows as before, found by their buckets."""
    source = folder(spark, sf_dir)
    rows, columns_of = source.read("lineitem"), source.columns("lineitem")
    place = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    chosen = rows.orderBy(*place).limit(3).select(*place, F.lit(1).alias("more"))
    altered = rows.join(F.broadcast(chosen.distinct()), place, "left").withColumn(
        "l_quantity", F.col("l_quantity") + F.coalesce("more", F.lit(0))
    )
    key = ["l_orderkey", "l_partkey", "l_linenumber"]
    sides = [
        Fingerprint(spark, workspace_folder(spark, f"lineitem_{name}"), key).write(version, columns_of)
        for name, version in (("old", rows), ("new", altered.select(*rows.columns)))
    ]
    return differing_rows(*sides)


MIDDLE = "2024-01-16 00:00:00"
LAST_TS = datetime(2024, 1, 3, tzinfo=timezone.utc)


def incremental_target(spark: SparkSession, sf_dir: str) -> Target:
    """Events of the first half of the time, then all of them, then once more nothing new."""
    target = workspace_target(spark, "increments", sf_dir)
    target.drop_schema()
    target.ensure()
    events = folder(spark, sf_dir).read("events")
    half = events.where(F.col("ts") < F.lit(MIDDLE).cast("timestamp_ntz"))
    cursor = Cursor("ts", ["event_id"], overlap=3_600_000_000)
    for moment, rows in ((LOAD_TS, half), (LATER_TS, events), (LAST_TS, events)):
        source = FrameSource(spark, {"events": rows}, types=JSON_COLUMNS)
        result = sync_increment(source, target, "events", cursor, SyncOptions(load_ts=moment))
        if result["status"] != "SUCCESS":
            raise RuntimeError(result["error"])
    return target


def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incremental_target(spark, sf_dir).read("events").drop(LOAD_ID)
    return stamped(rows).withColumn("PROPS", F.to_json("PROPS"))


def incremental_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = incremental_target(spark, sf_dir).read(AUDIT_TABLE)
    return audit.select(
        utc_moment(F.col("LOAD_START")).alias("LOAD_START"), "LOAD_TYPE", "ROWS_LOADED", "LAST_SOURCE_ID", "STATUS"
    )


PLAIN_LOADS = tuple(t for t in TABLES if t not in ("events", "embeddings"))

QUERIES: dict[str, Query] = {
    "discover_tables": discover,
    "row_counts": row_counts,
    "introspect_columns": columns,
    **{f"load_{table}": load(table) for table in PLAIN_LOADS},
    "load_events_variant": load_events_variant,
    "load_embeddings_text": load_embeddings_text,
    "variant_path_agg": variant_path_agg,
    "binary_hex_roundtrip": binary_hex_roundtrip,
    "load_lenient_json": lenient_json,
    "swap_publishes_new_rows": swap_publishes_new_rows,
    "backup_keeps_old_rows": backup_keeps_old_rows,
    "pointer_publish": pointer_publish,
    "resumed_load": resumed_load,
    "failed_validation_keeps_final": failed_validation_keeps_final,
    "malformed_json_is_error": malformed_json_is_error,
    "sync_results": sync_results,
    "validate_counts_all": validate_counts_all,
    "validate_json_types": validate_json_types,
    "load_audit": load_audit,
    "audit_key_check": audit_key_check,
    "run_summary": run_summary,
    "run_report": run_report,
    "failing_run_results": failing_run_results,
    "failing_run_failures": failing_run_failures,
    "failing_run_summary": failing_run_summary,
    "failing_run_report": failing_run_report,
    "reconcile_counts": reconcile_counts,
    "reconcile_totals": reconcile_totals,
    "reconcile_report": reconcile_report,
    "reconcile_synced": reconcile_synced,
    "catalog_profile": profile_full,
    "catalog_profile_lines": catalog_profile_lines,
    "schema_table_counts": schema_table_counts,
    "row_hash_orders": row_hash("orders", "o_orderkey"),
    "row_hash_lineitem": row_hash("lineitem", "l_orderkey", "l_partkey", "l_linenumber"),
    "row_hash_events": row_hash("events", "event_id"),
    "row_hash_conversations": row_hash("conversations", "conv_id", "turn"),
    "purge_messages": purge_messages,
    "purge_totals": purge_totals,
    "change_sets": order_changes,
    "change_sets_applied": order_changes_applied,
    "table_checksums": table_checksums,
    "checksum_tree_rows": altered_lineitem,
    "incremental_events": incremental_events,
    "incremental_audit": incremental_audit,
}
