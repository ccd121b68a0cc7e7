"""Reports over any days from stored daily sums, and late events.

The measures are sums, so those of a day can be added up: a batch of enriched
events is reduced to one row per report, day and group, and stored under the
batch's id. A late file is a batch of its own; it adds to its days without a scan
of theirs, and a batch that is stored again replaces itself, so it adds nothing.
Rates and the non-zero filter come after adding up, never before: a rate of a
month is no mean of its days' rates, and a group may reach six non-zero counters
only over several days.

Layout: ``folder/rules=R/batch_id=B/report=N/report_date=D``. A report over days
reads the folders of its rules, name and days, and no event.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from adtally.errors import EmptyDayError
from adtally.functions.dates import validate_date
from adtally.operators.distribution import finish_distribution
from adtally.operators.kpi import DIMENSIONS, REGION, finish_kpi
from adtally.operators.measures import INPUT_COLUMNS, MEASURE_NAMES, RULES, measure_column, measures
from adtally.schema import ENRICHED_SCHEMA


def _all_dims(dimensions: Mapping[str, Sequence[str]]) -> list[str]:
    return list(dict.fromkeys(d for dims in dimensions.values() for d in dims))


def sums_schema(dimensions: Mapping[str, Sequence[str]] = DIMENSIONS, source: StructType = ENRICHED_SCHEMA) -> StructType:
    """Columns of the stored sums; the types of the dimensions are those of ``source``."""
    schema = StructType([source[d] for d in _all_dims(dimensions)]).add("count", LongType())
    for name in MEASURE_NAMES:
        schema = schema.add(name, LongType())
    for name in ("batch_id", "report", "report_date"):
        schema = schema.add(name, StringType())
    return schema


def daily_sums(events: DataFrame, rules: str = "strict", dimensions: Mapping[str, Sequence[str]] = DIMENSIONS, date_col: str = "date_str") -> DataFrame:
    """One row per report, day and group: rows and the eleven measures, from one
    scan and one aggregation (a grouping set per report)."""
    dims = _all_dims(dimensions)
    aggs = [F.count(F.lit(1)).alias("count")] + [measure_column(m) for m in measures(rules)]
    needed = list(dict.fromkeys([date_col, *dims, *INPUT_COLUMNS]))
    grouped = events.select(*needed).groupingSets([[date_col, *d] for d in dimensions.values()], date_col, *dims).agg(*aggs, F.grouping_id().alias("_set"))
    name = F.lit(None).cast("string")
    for report, own in dimensions.items():
        # bit i from the right is set if the i-th last dimension is not grouped
        bits = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in own)
        name = F.when(F.col("_set") == bits, report).otherwise(name)
    return grouped.select(*dims, "count", *MEASURE_NAMES, name.alias("report"), F.col(date_col).alias("report_date"))


def store_sums(sums: DataFrame, folder: str, batch_id: str, rules: str = "strict") -> None:
    """Store the sums of a batch of events, in place of what the batch had stored."""
    if not re.fullmatch(r"[\w.-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r}: letters, digits, dot, dash and underscore only")
    _check_rules(rules)
    target = f"{folder.rstrip('/')}/rules={rules}/batch_id={batch_id}"
    sums.write.mode("overwrite").partitionBy("report", "report_date").parquet(target)


def _check_rules(rules: str) -> None:
    if rules not in RULES:
        raise ValueError(f"rules must be one of {RULES}, got {rules!r}")


def read_sums(spark: SparkSession, folder: str, report: str, first_day: str, last_day: str, rules: str = "strict",
              dimensions: Mapping[str, Sequence[str]] = DIMENSIONS, source: StructType = ENRICHED_SCHEMA) -> DataFrame:
    """The sums of one report over the days, of all batches, added up by group."""
    _check_rules(rules)
    validate_date(first_day), validate_date(last_day)
    stored = spark.read.schema(sums_schema(dimensions, source)).parquet(f"{folder.rstrip('/')}/rules={rules}")
    days = stored.where((F.col("report") == report) & F.col("report_date").between(first_day, last_day))
    # A measure is null only if all its days are: sum leaves nulls out, as over the events.
    return days.groupBy(*dimensions[report]).agg(F.sum("count").alias("count"), *[F.sum(m).alias(m) for m in MEASURE_NAMES])


def period_reports(spark: SparkSession, folder: str, first_day: str, last_day: str, report_date: str | None = None, rules: str = "strict",
                   dimensions: Mapping[str, Sequence[str]] = DIMENSIONS) -> dict[str, DataFrame]:
    """The reports of :func:`adtally.plans.daily_reports` over all days from
    ``first_day`` to ``last_day``, dated ``report_date`` (default: the last day).
    Without a stored row in these days EmptyDayError is raised."""
    report_date = report_date or last_day
    out: dict[str, DataFrame] = {}
    for name, dims in dimensions.items():
        sums = read_sums(spark, folder, name, first_day, last_day, rules, dimensions)
        if not out and sums.isEmpty():
            raise EmptyDayError(f"no sums stored from {first_day} to {last_day}")
        if tuple(dims) == REGION:
            out["region_distribution"] = finish_distribution(sums, dims, report_date)
            out["region_top10"] = out["region_distribution"].limit(10)
        out[f"kpi_{name}"] = finish_kpi(sums, dims, rules, report_date)
    return out
