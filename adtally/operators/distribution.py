"""Event counts per region, sorted, with the report date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.dates import report_date_col
from adtally.operators.kpi import REGION


def region_distribution(
    df: DataFrame, dims: Sequence[str] = REGION, report_date: str | None = None
) -> DataFrame:
    """Rows per group (NULL region is a group of its own), count descending.

    Ties are broken by the grouping columns (NULLs last) so the order, and any
    top-n taken from it, is deterministic.
    """
    return finish_distribution(df.groupBy(*dims).count(), dims, report_date)


def finish_distribution(counts: DataFrame, dims: Sequence[str], report_date: str | None = None) -> DataFrame:
    """Sort per-group ``count`` rows (ties by the groups, NULLs last), add the date."""
    dims = list(dims)
    return (
        counts.select(*dims, "count")
        .orderBy(F.desc("count"), *[F.asc_nulls_last(d) for d in dims])
        .withColumn("report_date", report_date_col(report_date))
    )


def region_top(df: DataFrame, n: int = 10, dims: Sequence[str] = REGION, report_date: str | None = None) -> DataFrame:
    """The first ``n`` rows of the distribution (planned as a top-k, not a full sort)."""
    return region_distribution(df, dims, report_date).limit(n)
