"""One day of the date-partitioned enriched table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adtally.errors import EmptyDayError
from adtally.functions.dates import validate_date
from adtally.schema import ENRICHED_SCHEMA


def read_day(
    spark: SparkSession,
    source: str,
    date: str,
    partition_col: str = "date_str",
    schema: StructType | None = ENRICHED_SCHEMA,
    columns: Sequence[str] | None = None,
    is_table: bool = False,
) -> DataFrame:
    """Rows of one day from a partitioned parquet path, or with ``is_table`` from
    a catalog table.

    The day is compared string-to-string with the partition column, so the
    scan prunes to that one partition folder (``PartitionFilters`` in the
    plan). A path is read with an explicit schema, because partition type
    inference would otherwise turn ``yyyy-MM-dd`` folders into a date column.
    """
    validate_date(date)
    if is_table:
        df = spark.read.table(source)
    else:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.parquet(source)
    df = df.where(F.col(partition_col) == F.lit(date))
    if columns is not None:
        df = df.select(*columns)
    return df


def require_rows(df: DataFrame, what: str = "report day") -> DataFrame:
    """Raise EmptyDayError when ``df`` has no rows (runs a limit-1 job)."""
    if df.isEmpty():
        raise EmptyDayError(f"no rows for {what}")
    return df
