"""KPI report: eleven measures per group, non-zero filter, three rates, date.

One operator serves the region report and the app / device / network /
carrier / channel reports: only the grouping columns change. The plan is a
single hash aggregation (partial aggregation before the shuffle, so a hot
group costs one row per map task), then a filter and a projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from adtally.functions.dates import report_date_col
from adtally.functions.rates import rate
from adtally.operators.measures import (
    INPUT_COLUMNS,
    MEASURE_NAMES,
    NONZERO,
    RATES,
    measure_column,
    measures,
)

REGION = ("province", "city")
# Grouping columns of the announced per-dimension reports.
DIMENSIONS = {
    "region": REGION,
    "app": ("appname",),
    "device": ("device",),
    "network": ("network",),
    "isp": ("isp",),
    "channel": ("channelid",),
}


def kpi_counts(df: DataFrame, dims: Sequence[str] = REGION, rules: str = "strict") -> DataFrame:
    """The eleven measures per group, without the non-zero filter."""
    dims = list(dims)
    aggs = [measure_column(m) for m in measures(rules)]
    needed = dims + [c for c in INPUT_COLUMNS if c not in dims]
    return df.select(*needed).groupBy(*dims).agg(*aggs)


def nonzero_filter(df: DataFrame) -> DataFrame:
    return df.where(" AND ".join(f"{name} != 0" for name in NONZERO))


def with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({name: rate(num, den) for name, num, den in RATES})


def kpi_report(
    df: DataFrame,
    dims: Sequence[str] = REGION,
    rules: str = "strict",
    report_date: str | None = None,
    date_first: bool | None = None,
) -> DataFrame:
    """Measures -> groups with all six counters non-zero -> rates -> date.

    Column order follows the reference's two forms: strict puts the date
    last, loose puts it first (override with ``date_first``).
    """
    return finish_kpi(kpi_counts(df, dims, rules), dims, rules, report_date, date_first)


def finish_kpi(
    counts: DataFrame,
    dims: Sequence[str],
    rules: str = "strict",
    report_date: str | None = None,
    date_first: bool | None = None,
) -> DataFrame:
    """Non-zero filter, rates, report date and column order over per-group
    measures (the output of :func:`kpi_counts` or of a grouping-sets pass)."""
    dims = list(dims)
    if date_first is None:
        date_first = rules == "loose"
    out = with_rates(nonzero_filter(counts.select(*dims, *MEASURE_NAMES)))
    out = out.withColumn("report_date", report_date_col(report_date))
    body = [*dims, *MEASURE_NAMES, *(r[0] for r in RATES)]
    return out.select("report_date", *body) if date_first else out.select(*body, "report_date")
