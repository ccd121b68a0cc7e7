"""The two batch jobs: ETL (log -> enriched partitioned table) and reports.

Both take the caller's session and an explicit date; neither creates, stops
or exits anything.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adtally.functions.dates import report_date_col, yesterday
from adtally.operators.distribution import finish_distribution, region_distribution
from adtally.operators.enrich import enrich_ips
from adtally.operators.kpi import DIMENSIONS, REGION, finish_kpi, kpi_report
from adtally.operators.measures import INPUT_COLUMNS, measure_column, measures
from adtally.schema import RAW_LOG_SCHEMA
from adtally.session import shared_dir
from adtally.sinks.partitioned import write_partitions, write_table_partitions
from adtally.sinks.upsert import upsert_partitions
from adtally.sources.day import read_day, require_rows
from adtally.sources.json_log import broken_lines, is_broken, read_ad_log, read_split_log, sound_rows


log = logging.getLogger(__name__)

DATE_COLUMN = "date_str"
QUARANTINE_SCHEMA = "line string, file string"

#: Where a report goes: a parquet path, or a function that takes the report.
Output = str | Callable[[DataFrame, Sequence[str]], None]


def stamp_date(df: DataFrame, date: str | None = None, col: str = "date_str") -> DataFrame:
    """Set the partition column to the run date (default: yesterday)."""
    return df.withColumn(col, report_date_col(date))


def run_etl(
    spark: SparkSession,
    log_path: str,
    ip_dictionary: DataFrame,
    output: str,
    run_date: str | None = None,
    to_table: bool = False,
    log_schema=RAW_LOG_SCHEMA,
    stamp: bool = True,
    table_format: str = "parquet",
    mode: str | None = None,
    rebalance: bool = False,
    max_records_per_file: int | None = None,
    table_path: str | None = None,
    quarantine: str | None = None,
    observation: Observation | None = None,
    **lookup,
) -> DataFrame:
    """JSON log -> IP enrichment -> date stamp -> rerun-safe partitioned write.

    ``output`` is a parquet path, or a catalog table name with
    ``to_table=True`` (``table_format='hive'`` for a Hive-format table on a
    session with Hive support). ``stamp=False`` keeps a ``date_str`` already
    in the log. ``log_schema=None`` infers it (a pass of its own).

    Lines that cannot be read never become rows of the output, unless ``mode``
    asks for it. They are told apart in the scan that writes the others, and
    counted in it with them (``observe``): ``observation`` then has ``rows`` and
    ``broken``. With ``quarantine``, a folder, their text and file replace those
    of the same load date (``run_date``) there; only a log that has some is read
    again for them. Without, their number is logged. ``mode`` is a JSON parse
    mode instead: PERMISSIVE keeps a malformed line as a row of NULLs,
    DROPMALFORMED drops it, FAILFAST fails the job.
    ``rebalance=True`` sizes output files per day for multi-day backfills
    (see :func:`write_partitions`); ``table_path`` places a new catalog table
    (default: the session's warehouse). Every column of the log is kept, the
    date column comes last. Returns the enriched DataFrame written.
    """
    if mode is not None and quarantine is not None:
        raise ValueError("give a parse mode or a quarantine folder")
    split = None
    if mode is not None:
        rows = read_ad_log(spark, log_path, schema=log_schema, mode=mode)
        if observation is not None:
            rows = rows.observe(observation, F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("broken"))
    else:
        split = read_split_log(spark, log_path, log_schema)
        observation = observation or Observation()
        rows = sound_rows(split.observe(observation, F.count_if(~is_broken()).alias("rows"), F.count_if(is_broken()).alias("broken")))
    enriched = enrich_ips(rows, ip_dictionary, **lookup)
    if stamp:
        enriched = stamp_date(enriched, run_date)
    enriched = enriched.select(*[c for c in enriched.columns if c != DATE_COLUMN], DATE_COLUMN)
    files = {"rebalance": rebalance, "max_records_per_file": max_records_per_file}
    if to_table:
        write_table_partitions(enriched, output, fmt=table_format, path=table_path, **files)
    else:
        write_partitions(enriched, output, **files)
    if split is not None:
        _set_aside(split, observation.get["broken"], quarantine, run_date)
    return enriched


def _set_aside(split: DataFrame, broken: int, quarantine: str | None, run_date: str | None) -> None:
    """Replace the quarantine of the load date by the broken lines of ``split``."""
    if broken:
        log.warning("%d broken line(s) of the log %s", broken, f"go to {quarantine}" if quarantine else "are left out")
    if quarantine is not None:
        lines = broken_lines(split) if broken else split.sparkSession.createDataFrame([], QUARANTINE_SCHEMA)
        lines.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/load_date={run_date or yesterday()}")


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """(line, file, load_date) of every broken line set aside."""
    return spark.read.schema(f"{QUARANTINE_SCHEMA}, load_date string").parquet(quarantine)


def _gid(all_dims: Sequence[str], group: Sequence[str]) -> int:
    # grouping_id(): bit (n-1-i) is set when all_dims[i] is not grouped.
    n = len(all_dims)
    return sum(1 << (n - 1 - i) for i, c in enumerate(all_dims) if c not in group)


def daily_reports(
    day: DataFrame,
    report_date: str,
    rules: str = "strict",
    dimensions: Mapping[str, Sequence[str]] = DIMENSIONS,
) -> dict[str, DataFrame]:
    """All reports of one day from ONE scan and ONE aggregation.

    A grouping-sets aggregation computes row counts and the eleven measures
    for every report dimension in a single pass (partial aggregation before
    the shuffle). Its result has one row per group -- bounded by the
    dimensions' cardinality, not by the number of events -- and is
    checkpointed to the shared checkpoint folder, so each report is a cheap
    filter of it and a lost executor never forces a rescan of the day.

    Returns ``region_distribution``, its first ten rows as ``region_top10``,
    and one ``kpi_<name>`` per dimension.
    """
    all_dims: list[str] = []
    for dims in dimensions.values():
        all_dims += [d for d in dims if d not in all_dims]
    sets = [list(d) for d in dimensions.values()]
    aggs = [F.count(F.lit(1)).alias("count")] + [measure_column(m) for m in measures(rules)]
    shared_dir(day.sparkSession)
    grouped = (
        day.select(*all_dims, *[c for c in INPUT_COLUMNS if c not in all_dims])
        .groupingSets(sets, *all_dims)
        .agg(*aggs, F.grouping_id().alias("_gid"))
        .checkpoint(eager=True)
    )
    out: dict[str, DataFrame] = {}
    for name, dims in dimensions.items():
        part = grouped.where(F.col("_gid") == _gid(all_dims, dims))
        if tuple(dims) == REGION:
            out["region_distribution"] = finish_distribution(part, dims, report_date)
            out["region_top10"] = out["region_distribution"].limit(10)
        out[f"kpi_{name}"] = finish_kpi(part, dims, rules, report_date)
    return out


def table_output(table: str, path: str | None = None) -> Output:
    """An output that upserts a report into a catalog table, created at ``path``."""
    def deliver(report: DataFrame, keys: Sequence[str]) -> None:
        upsert_partitions(report, table, keys=keys, partition_col="report_date", is_table=True, table_path=path)

    return deliver


def run_reports(
    spark: SparkSession,
    source: str,
    report_date: str,
    outputs: Mapping[str, Output] | None = None,
    rules: str = "strict",
    is_table: bool = False,
) -> dict[str, DataFrame]:
    """Read one day, check it is not empty, compute every report in one scan
    (:func:`daily_reports`), and deliver each report named in ``outputs``.

    An output is a parquet path (upserted by report date and dimensions),
    :func:`table_output` for a catalog table, or any function of the report and
    its key columns. ``source`` is a parquet path, or with ``is_table`` a table.
    """
    reports = daily_reports(_day(spark, source, report_date, is_table), report_date, rules)
    deliver(reports, outputs or {})
    return reports


@contextmanager
def separate_reports(
    spark: SparkSession, source: str, report_date: str, rules: str = "strict", is_table: bool = False
) -> Iterator[dict[str, DataFrame]]:
    """The reports each on its own over the persisted day (memory and disk),
    which is released when the ``with`` block ends:

        with separate_reports(spark, source, date) as reports:
            deliver(reports, outputs)
    """
    day = _day(spark, source, report_date, is_table).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        reports = {"region_distribution": region_distribution(day, REGION, report_date)}
        reports["region_top10"] = reports["region_distribution"].limit(10)
        for name, dims in DIMENSIONS.items():
            reports[f"kpi_{name}"] = kpi_report(day, dims, rules, report_date)
        yield reports
    finally:
        day.unpersist()


def _day(spark: SparkSession, source: str, report_date: str, is_table: bool) -> DataFrame:
    cols = sorted({c for dims in DIMENSIONS.values() for c in dims} | set(INPUT_COLUMNS))
    return require_rows(read_day(spark, source, report_date, columns=cols, is_table=is_table))


def deliver(reports: Mapping[str, DataFrame], outputs: Mapping[str, Output]) -> None:
    """Send each report named in ``outputs`` to its output."""
    for name, output in outputs.items():
        report = reports[name]
        keys = [c for c in report.columns if c in {d for v in DIMENSIONS.values() for d in v}]
        if callable(output):
            output(report, keys)
        else:
            upsert_partitions(report, output, keys=keys, partition_col="report_date")
