"""Command line: one job per layer.

    spark-submit bazaarlake/cli.py --root s3a://lake ingest --mode incremental ...
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from bazaarlake.contracts import GOLD, PLATINUM, RAW
from bazaarlake.plans.pipeline import build_gold, build_platinum, build_silver
from bazaarlake.plans.views import create_views
from bazaarlake.session import tune
from bazaarlake.sources import catalog
from bazaarlake.sources.csv_drop import (
    LoadError,
    full_load,
    incremental_load,
    validate_layer,
)
from bazaarlake.sources.layers import Lake

LOADS = {
    "full_load": (full_load, "{table}.csv"),
    "incremental": (incremental_load, "{table}_new.csv"),
}
BUILDS = {
    "silver": (build_silver, RAW),
    "gold": (build_gold, GOLD),
    "platinum": (build_platinum, PLATINUM),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="bazaarlake", description=__doc__)
    top.add_argument("--root", required=True, help="folder that holds the layers")
    jobs = top.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="CSV files into bronze")
    ingest.add_argument("--mode", choices=list(LOADS), required=True)
    ingest.add_argument("--source", required=True, help="folder of CSV files")
    ingest.add_argument("--file-name", help="pattern with {table}")
    ingest.add_argument(
        "--multi-line", nargs="*", default=[], metavar="TABLE", help="fields may span lines"
    )

    validate = jobs.add_parser("validate", help="row counts of bronze")
    validate.add_argument(
        "--expect", nargs="*", default=[], metavar="TABLE=ROWS", help="expected counts"
    )

    for layer, (_, tables) in BUILDS.items():
        build = jobs.add_parser(layer, help=f"build {layer} tables")
        build.add_argument("--table", choices=[*tables, "all"], default="all")

    register = jobs.add_parser("catalog", help="external tables over the marts")
    register.add_argument(
        "--action", choices=["create", "delete", "list"], default="create"
    )
    register.add_argument("--table", choices=[*PLATINUM, "all"], default="all")
    register.add_argument("--database", required=True)
    register.add_argument("--views", action="store_true", help="also create BI views")
    return top


def _print(report) -> None:
    """All rows: reports have a row per table or column."""
    report.show(report.count(), truncate=False)


def _catalog(lake: Lake, args) -> None:
    spark, database = lake.spark, args.database
    everything = args.table == "all"
    names = list(PLATINUM) if everything else [args.table]
    if args.action == "create":
        catalog.register(lake, database, names)
        if args.views:
            create_views(spark, database)
    elif args.action == "list":
        _print(catalog.list_tables(spark, database))
    elif everything:
        catalog.drop_database(spark, database)
    else:
        catalog.drop_table(spark, database, args.table)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    session = spark or SparkSession.builder.appName(f"bazaarlake-{args.job}").getOrCreate()
    lake = Lake(tune(session), args.root)
    try:
        if args.job == "ingest":
            load, pattern = LOADS[args.mode]
            report = load(
                lake,
                args.source,
                file_name=args.file_name or pattern,
                multi_line=args.multi_line,
            )
            _print(report)
        elif args.job == "validate":
            expected = {t: int(n) for t, n in (e.split("=") for e in args.expect)}
            report = validate_layer(lake, "bronze", RAW, expected)
            _print(report)
            return int(not report.filter("status IN ('FAIL', 'MISSING')").isEmpty())
        elif args.job in BUILDS:
            build, _ = BUILDS[args.job]
            names = () if args.table == "all" else (args.table,)
            for name, rows in build(lake, names).items():
                print(f"{name}: {rows} rows")
        else:
            _catalog(lake, args)
    except LoadError as failure:
        _print(failure.report)
        print(failure, file=sys.stderr)
        return 1
    finally:
        if spark is None:
            session.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
