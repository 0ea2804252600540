"""Command line: ``python -m tableferry sync|reconcile|profile`` (or through ``spark-submit``)."""

from __future__ import annotations

import argparse
import os
import sys
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

from tableferry.plans.profile import catalog_profile, profile_lines
from tableferry.plans.reconcile import mismatch_lines, reconcile, reconcile_lines, total_line
from tableferry.plans.status import SUCCESS
from tableferry.plans.sync import SyncOptions, sync_all
from tableferry.operators.target import Target
from tableferry.session import build_session
from tableferry.sources import CatalogSource, JdbcSource, ParquetSource, Source, Split


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="tableferry")
    commands = main.add_subparsers(dest="command", required=True)

    sync = commands.add_parser("sync", help="full refresh of every source table")
    _source_arguments(sync)
    _target_arguments(sync)
    sync.add_argument("--workers", type=int, default=1, help="tables loaded at the same time")
    sync.add_argument("--exclude", action="append", default=[], metavar="TABLE")
    sync.add_argument("--keep-backups", type=int, default=0)
    sync.add_argument("--recount-source", action="store_true")
    sync.add_argument("--drop-orphans", action="store_true", help="delete folders of lost runs")
    sync.add_argument("--title", default="Table sync")

    compare = commands.add_parser("reconcile", help="row counts of source and target")
    _source_arguments(compare)
    _target_arguments(compare)
    compare.add_argument("--exclude", action="append", default=[], metavar="TABLE")
    compare.add_argument("--target-jdbc-url", help="count in another database instead")
    compare.add_argument("--target-jdbc-schema", default="public")
    compare.add_argument("--target-jdbc-option", action="append", default=[], metavar="KEY=VALUE")

    profile = commands.add_parser("profile", help="tables and row counts per target schema")
    profile.add_argument("--schema", action="append", help="default: all schemas")
    return main


def _source_arguments(command: argparse.ArgumentParser) -> None:
    where = command.add_mutually_exclusive_group(required=True)
    where.add_argument("--source-path", help="folder of <table>.parquet")
    where.add_argument("--source-schema", help="schema of the session catalog")
    where.add_argument("--jdbc-url", help="user and password from DB_USER and DB_PASSWORD")
    command.add_argument("--jdbc-schema", default="public")
    command.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    command.add_argument("--batch-size", type=int, default=2000, help="rows fetched at once")
    command.add_argument(
        "--split-column", action="append", default=[], metavar="TABLE.COLUMN", help="read by this key"
    )
    command.add_argument(
        "--json-column", action="append", default=[], metavar="TABLE.COLUMN", help="JSON held as text"
    )


def _target_arguments(command: argparse.ArgumentParser) -> None:
    command.add_argument("--target-schema", default="ods")
    command.add_argument("--target-root", help="folder for a new target schema")


def source_of(spark: SparkSession, args: argparse.Namespace) -> Source:
    types: dict[str, dict[str, str]] = defaultdict(dict)
    for item in args.json_column:
        table, _, column = item.partition(".")
        types[table][column] = "json"
    if args.source_path:
        return ParquetSource(spark, args.source_path, types=types)
    if args.source_schema:
        return CatalogSource(spark, args.source_schema, types=types)
    properties = _properties(args.jdbc_option)
    for key, variable in (("user", "DB_USER"), ("password", "DB_PASSWORD")):
        if variable in os.environ:
            properties.setdefault(key, os.environ[variable])
    keys = (item.partition(".") for item in args.split_column)
    return JdbcSource(
        spark,
        args.jdbc_url,
        args.jdbc_schema,
        properties,
        splits={table: Split(column=column) for table, _, column in keys},
        fetch_size=args.batch_size,
    )


def _properties(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.command == "profile":
        _print_lines(profile_lines(catalog_profile(spark, args.schema)))
        return 0
    source = source_of(spark, args)
    target = Target(spark, args.target_schema, args.target_root)
    if args.command == "reconcile":
        if args.target_jdbc_url:
            properties = _properties(args.target_jdbc_option)
            target = JdbcSource(spark, args.target_jdbc_url, args.target_jdbc_schema, properties)
        details, totals = reconcile(source, target, args.exclude)
        _print_lines(reconcile_lines(details).orderBy("table_name"))
        _print_lines(total_line(totals))
        _print_lines(mismatch_lines(details).orderBy("table_name"))
        return 1 if totals.first().mismatches else 0
    options = SyncOptions(
        exclude=args.exclude,
        workers=args.workers,
        keep_backups=args.keep_backups,
        recount_source=args.recount_source,
        drop_orphans=args.drop_orphans,
    )
    outcome = sync_all(source, target, options)
    print(outcome.report(args.title).first().report)
    return 0 if outcome.summary().first().status == SUCCESS else 1


def _print_lines(lines: DataFrame) -> None:
    for row in lines.toLocalIterator():
        print(row.line)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return run(build_session(f"tableferry {args.command}"), args)


if __name__ == "__main__":
    sys.exit(main())
