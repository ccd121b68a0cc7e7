"""Command-line entry points (for spark-submit):

    python -m adtally etl --log LOG_DIR --dictionary DICT --output OUT [--date yyyy-MM-dd]
    python -m adtally reports --source OUT --date yyyy-MM-dd --output REPORTS
    python -m adtally sums --source OUT --date yyyy-MM-dd --sums SUMS
    python -m adtally period --sums SUMS --first yyyy-MM-dd --last yyyy-MM-dd --output REPORTS

``--output`` and ``--source`` are parquet paths; with ``--table`` they are
catalog tables (for reports, ``--output`` is then the prefix of the tables'
names). Tables outlive the session only with a persistent catalog: ``--hive``.

The dictionary is parquet with (ip_start, ip_end, province, city), or with
(ip_start, ip_end, region) where region is the five-part `|`-separated
string. Only this module creates a session; the library functions take one.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from adtally.functions.dates import yesterday
from adtally.operators.enrich import dictionary_from_regions
from adtally.plans.daily_sums import daily_sums, period_reports, store_sums
from adtally.plans.jobs import deliver, run_etl, run_reports, table_output
from adtally.schema import DATED_LOG_SCHEMA, RAW_LOG_SCHEMA
from adtally.sources.day import read_day, require_rows

REPORTS = ("region_distribution", "kpi_region", "kpi_app", "kpi_device", "kpi_network", "kpi_isp", "kpi_channel")


def _dictionary(spark: SparkSession, path: str):
    df = spark.read.parquet(path)
    if "region" in df.columns and "province" not in df.columns:
        return dictionary_from_regions(df)
    return df


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="adtally")
    sub = parser.add_subparsers(dest="command", required=True)
    etl = sub.add_parser("etl", help="JSON log -> enriched, date-partitioned table")
    etl.add_argument("--log", required=True)
    etl.add_argument("--dictionary", required=True)
    etl.add_argument("--output", required=True, help="parquet path, or table name with --table")
    etl.add_argument("--date", default=None, help="partition date (default: yesterday)")
    etl.add_argument("--keep-date", action="store_true", help="keep the date_str of the log")
    etl.add_argument("--parse-mode", choices=("PERMISSIVE", "DROPMALFORMED", "FAILFAST"), default=None,
                     help="Spark's handling of broken lines (default: they are left out of the table and counted)")
    etl.add_argument("--quarantine", default=None, help="folder for the text of broken lines, by load date")
    etl.add_argument("--log-schema", default=None, help="DDL of the log's columns, to keep more than the standard ones")
    etl.add_argument("--infer-schema", action="store_true", help="infer the log's columns (one more pass over the log)")
    etl.add_argument("--rebalance", action="store_true", help="size the files per day (multi-day backfills)")
    etl.add_argument("--table-format", choices=("parquet", "orc", "hive"), default="parquet")
    rep = sub.add_parser("reports", help="all reports of one day -> upserted report tables")
    rep.add_argument("--source", required=True, help="enriched parquet path, or table name with --table")
    rep.add_argument("--date", default=None, help="report date (default: yesterday)")
    rep.add_argument("--output", required=True, help="folder, or prefix of table names with --table")
    rep.add_argument("--rules", choices=("strict", "loose"), default="strict")
    day = sub.add_parser("sums", help="reduce one day to stored sums, from which reports over any days are made")
    day.add_argument("--source", required=True, help="enriched parquet path, or table name with --table")
    day.add_argument("--date", default=None, help="day (default: yesterday)")
    day.add_argument("--sums", required=True, help="folder of the sums")
    day.add_argument("--batch", default=None, help="id of the batch (default: day-DATE); a rerun replaces what it stored")
    period = sub.add_parser("period", help="all reports over several days from stored sums")
    period.add_argument("--sums", required=True, help="folder of the sums")
    period.add_argument("--first", required=True, help="first day")
    period.add_argument("--last", required=True, help="last day, also the report date")
    period.add_argument("--output", required=True, help="folder, or prefix of table names with --table")
    for command in (day, period):
        command.add_argument("--rules", choices=("strict", "loose"), default="strict")
    for command in (etl, rep, day, period):
        command.add_argument("--table", action="store_true", help="names are catalog tables")
        command.add_argument("--table-path", default=None, help="folder for the files of new tables")
        command.add_argument("--hive", action="store_true", help="use the Hive catalog")
    return parser


def _outputs(args: argparse.Namespace) -> dict:
    """Where each report goes: a table or a folder of its name."""
    if not args.table:
        return {n: f"{args.output.rstrip('/')}/{n}" for n in REPORTS}
    place = args.table_path and args.table_path.rstrip("/")
    return {n: table_output(f"{args.output}_{n}", place and f"{place}/{n}") for n in REPORTS}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    own = spark is None
    if own:
        builder = SparkSession.builder.appName(f"adtally-{args.command}")
        spark = (builder.enableHiveSupport() if args.hive else builder).getOrCreate()
    try:
        if args.command == "etl":
            schema = None if args.infer_schema else args.log_schema or (DATED_LOG_SCHEMA if args.keep_date else RAW_LOG_SCHEMA)
            run_etl(spark, args.log, _dictionary(spark, args.dictionary), args.output, run_date=args.date,
                    to_table=args.table, log_schema=schema, stamp=not args.keep_date, mode=args.parse_mode, quarantine=args.quarantine,
                    rebalance=args.rebalance, table_format=args.table_format, table_path=args.table_path)
        elif args.command == "sums":
            date = args.date or yesterday()
            rows = require_rows(read_day(spark, args.source, date, is_table=args.table))
            store_sums(daily_sums(rows, args.rules), args.sums, args.batch or f"day-{date}", args.rules)
        elif args.command == "period":
            deliver(period_reports(spark, args.sums, args.first, args.last, rules=args.rules), _outputs(args))
        else:
            run_reports(spark, args.source, args.date or yesterday(), _outputs(args), rules=args.rules, is_table=args.table)
        return 0
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
