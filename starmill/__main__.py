"""Command line: ``python -m starmill <command> ...``.

Connection data for a relational source or sink come from a JSON file of Spark JDBC options, never
from the code or the command line.
"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from starmill.operators.profile import column_profile, describe
from starmill.operators.quality import rental_checks
from starmill.operators.types import type_report
from starmill.plans import jobs
from starmill.plans.extract import Journal, extract_history, extract_increment, history_manifest
from starmill.session import build_session
from starmill.sinks.jdbc import load_spec_jdbc
from starmill.sinks.report import LoadFailed, Outcome, report
from starmill.sources.files import read_registry, table_glob
from starmill.sources.jdbc import JdbcSource
from starmill.sources.records import read_chunks
from starmill.specs import TableSpec


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="starmill")
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, *options: str, **defaults: str) -> None:
        command = commands.add_parser(name)
        for option in options:
            command.add_argument(f"--{option}", required=option not in defaults, default=defaults.get(option))
        command.add_argument("--report", default="", help="folder for the report as JSON lines; else it is printed")

    layout = {"layout": "zone", "multi-line": "yes", "mixed": ""}
    late = {"late-keys": "no"}
    add("extract-history", "jdbc", "schema", "target", "journal", "late-keys", **late)
    add("extract-plan", "jdbc", "schema")
    add("extract-day", "jdbc", "schema", "target", "journal", "run-date", "late-keys", **late)
    add("clean-day", "raw", "target", "run-date", "layout", "multi-line", "mixed", **layout)
    add("clean-history", "raw", "target", "layout", "multi-line", "mixed", **layout)
    add("load-day", "raw", "run-date", "target", "jdbc", "schema", "layout", "multi-line", "mixed", target="", jdbc="", schema="", **layout)
    add("star-day", "raw", "target", "run-date", "jdbc", "schema", "layout", "multi-line", "mixed", target="", jdbc="", schema="", **layout)
    add("quality", "raw", "run-date", "layout", "multi-line", "mixed", **layout)
    add("profile", "raw", "run-date", "table", "column", "layout", "multi-line", "mixed", **layout)
    add("types", "raw", "run-date", "table", "layout", layout="zone")
    return top


def jdbc_file(path: str) -> dict[str, str]:
    return {k: str(v) for k, v in json.loads(Path(path).read_text(encoding="utf-8")).items()}


def source(spark: SparkSession, path: str, schema: str) -> JdbcSource:
    options = jdbc_file(path)
    return JdbcSource(spark, options.pop("url"), schema, options, quote=options.pop("quote", '"'))


def jdbc_sink(path: str, schema: str, *, star: bool) -> jobs.Sink:
    """Cleaned tables and facts get their new keys, dimensions are replaced."""
    options = jdbc_file(path)
    url = options.pop("url")

    def sink(df: DataFrame, spec: TableSpec) -> int:
        return load_spec_jdbc(df, spec, url, schema, options, replace=star and spec.mode == "overwrite")

    return sink


def run(spark: SparkSession, a: argparse.Namespace) -> DataFrame | list[Outcome]:
    day = getattr(a, "run_date", None)
    raw = {"layout": getattr(a, "layout", "zone"), "multi_line": getattr(a, "multi_line", "yes") == "yes"}
    if getattr(a, "mixed", ""):
        raw["mixed"] = a.mixed == "yes"
    late = getattr(a, "late_keys", "no") == "yes"
    if a.command == "extract-history":
        return extract_history(source(spark, a.jdbc, a.schema), a.target, Journal(spark, a.journal), late_keys=late)
    if a.command == "extract-plan":
        return history_manifest(source(spark, a.jdbc, a.schema))
    if a.command == "extract-day":
        return extract_increment(source(spark, a.jdbc, a.schema), a.target, Journal(spark, a.journal), day, late_keys=late)
    if a.command == "clean-day":
        return jobs.clean_day(spark, a.raw, a.target, day, **raw)
    if a.command == "clean-history":
        return jobs.clean_history(spark, a.raw, a.target, **raw)
    if a.command == "load-day":
        sink = jdbc_sink(a.jdbc, a.schema, star=False) if a.jdbc else jobs.file_warehouse(a.target, day)
        return jobs.load_day(spark, a.raw, day, sink, **raw)
    if a.command == "star-day":
        sink = jdbc_sink(a.jdbc, a.schema, star=True) if a.jdbc else jobs.star_sink(a.target, unique=True)
        return jobs.star_day(spark, a.raw, sink, day, **raw)
    if a.command == "types":
        return type_report(read_chunks(spark, table_glob(a.raw, a.table, day, layout=a.layout), recursive=a.layout == "hive"))
    tables = read_registry(spark, a.raw, day, **raw)
    if a.command == "quality":
        return rental_checks(tables)
    show(column_profile(tables[a.table], a.table))
    return describe(tables[a.table], [a.column])


def show(lines: DataFrame) -> None:
    """All lines of a report, one JSON object each, as they come."""
    for line in lines.toJSON().toLocalIterator():
        print(line)


def main(argv: list[str] | None = None) -> int:
    arguments = parser().parse_args(argv)
    spark = build_session(f"starmill {arguments.command}")
    try:
        out = run(spark, arguments)
    except LoadFailed as failure:
        show(report(spark, failure.outcomes))
        return 1
    lines = out if isinstance(out, DataFrame) else report(spark, out)
    if arguments.report:
        lines.write.mode("overwrite").json(arguments.report)
    else:
        show(lines)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
