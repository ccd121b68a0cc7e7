"""Keyed upsert into a partitioned report table (parquet path or catalog table).

The new rows replace old rows with the same key; old rows with other keys
stay. Only the partitions the new rows touch are read and rewritten, so the
cost follows the size of the new data, not of the whole history:

    result(p) = new(p)  union  (old(p) anti-join new(p) on key)   for each p in new

Keys are compared NULL-safely (a NULL province is a key value of its own).
The new rows (one per key) are checkpointed first, so they are computed once
for the key check, the partition list, the anti-join and the union; the merged
rows are checkpointed before the overwrite, because the job reads the very
partitions it replaces. A batch with two rows of one key is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.errors import DuplicateKeyError
from adtally.session import shared_dir
from adtally.sinks.partitioned import write_partitions, write_table_partitions


#: Most partition values that are put into a filter as a list.
LISTED_PARTITIONS = 10_000


def _read_existing(new: DataFrame, target: str, is_table: bool) -> DataFrame | None:
    spark = new.sparkSession
    if is_table:
        if not spark.catalog.tableExists(target):
            return None
        return spark.read.table(target).select(*new.columns)
    try:
        return spark.read.schema(new.schema).parquet(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def touched_rows(old: DataFrame, new: DataFrame, partition_col: str) -> DataFrame:
    """The rows of ``old`` in the partitions that ``new`` has rows in. Up to
    ``LISTED_PARTITIONS`` values are a literal list, so that the scan of ``old``
    lists and reads only their folders; beyond it a semi-join picks the rows."""
    values = new.select(partition_col).distinct()
    listed = [r[0] for r in values.limit(LISTED_PARTITIONS + 1).collect()]
    if len(listed) > LISTED_PARTITIONS:
        found = values.withColumnRenamed(partition_col, "_touched")
        return old.join(found, old[partition_col].eqNullSafe(found["_touched"]), "left_semi")
    some = F.col(partition_col).isin([v for v in listed if v is not None])
    return old.where(some | F.col(partition_col).isNull() if None in listed else some)


def upsert_partitions(
    new: DataFrame,
    target: str,
    keys: Sequence[str],
    partition_col: str = "report_date",
    is_table: bool = False,
    table_path: str | None = None,
) -> None:
    """Upsert ``new`` into the report table partitioned by ``partition_col``:
    a parquet path, or a catalog table with ``is_table=True`` (created on
    first use, at ``table_path`` if given)."""
    keys = list(keys)
    if partition_col not in keys:
        keys = [partition_col, *keys]
    shared_dir(new.sparkSession)  # make sure a checkpoint folder is set
    new = new.checkpoint(eager=True)
    twice = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n").take(1)
    if twice:
        raise DuplicateKeyError(f"two new rows have the key {twice[0].asDict()}")
    old = _read_existing(new, target, is_table)
    if old is None:
        merged = new
    else:
        old_touched = touched_rows(old, new, partition_col)
        on = [old_touched[k].eqNullSafe(new[k]) for k in keys]
        kept = old_touched.join(new, on, "left_anti")
        merged = new.unionByName(kept).checkpoint(eager=True)
    if is_table:
        body = [c for c in merged.columns if c != partition_col]
        write_table_partitions(merged.select(*body, partition_col), target, [partition_col], path=table_path)
    else:
        write_partitions(merged, target, [partition_col])
