"""Date-partitioned writes that can be rerun safely.

A rerun of the same day replaces exactly the partitions present in the new
data and leaves every other day untouched (dynamic partition overwrite).
Spark's defaults do not give this: a plain overwrite is *static* and deletes
all other days, and a plain append doubles the day on rerun.

No ``coalesce(1)``: that would pull the scan and the IP lookup of the whole
load into one task. Each task writes its own files into the partitions it
holds; ``max_records_per_file`` bounds file size.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def write_partitions(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = ("date_str",),
    fmt: str = "parquet",
    max_records_per_file: int | None = None,
    rebalance: bool = False,
) -> None:
    """Overwrite only the partitions present in ``df`` under ``path``.

    ``rebalance=True`` (for multi-day backfills) adds Spark's ``rebalance``
    hint on the partition columns: one shuffle, after which AQE splits a hot
    day into advisory-size pieces and merges small ones, so the output has a
    few right-sized files per day instead of one per task per day. A daily
    load (one day per run) does not need it and keeps the write shuffle-free.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_cols)
    writer = (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    # Catalog tables ignore the per-write option; only the session setting
    # makes insertInto dynamic. Restore the caller's value afterwards.
    old = spark.conf.get(_OVERWRITE_MODE, None)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_OVERWRITE_MODE)
        else:
            spark.conf.set(_OVERWRITE_MODE, old)


def write_table_partitions(
    df: DataFrame,
    table: str,
    partition_cols: Sequence[str] = ("date_str",),
    fmt: str = "parquet",
    path: str | None = None,
    append: bool = False,
    rebalance: bool = False,
    max_records_per_file: int | None = None,
) -> None:
    """Insert ``df`` into a partitioned catalog table, creating it if needed.

    Default: dynamic overwrite of the partitions in ``df`` (rerun-safe).
    ``append=True`` keeps the reference's plain append (a rerun duplicates).
    ``fmt='hive'`` needs a session with Hive support. ``rebalance`` and
    ``max_records_per_file`` are as in :func:`write_partitions`.
    """
    spark = df.sparkSession
    partition_cols = list(partition_cols)
    if not spark.catalog.tableExists(table):
        # An empty frame of its own: a job over df would end its observations.
        creator = spark.createDataFrame([], df.schema).write.format(fmt).partitionBy(*partition_cols)
        if path:
            creator = creator.option("path", path)
        creator.saveAsTable(table)
    # insertInto matches columns by position, partition columns last.
    target = spark.read.table(table).columns
    ordered = df.select(*target)
    if rebalance:
        ordered = ordered.hint("rebalance", *partition_cols)
    writer = ordered.write
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if append:
        writer.insertInto(table)
        return
    with _dynamic_overwrite(spark):
        writer.insertInto(table, overwrite=True)
