"""The KPI report written as Spark SQL: two steps over views, or one CTE.

The SQL text is generated from the same measure table as the DataFrame form,
so the three forms agree by construction; Catalyst inlines the views / CTE
and plans all of them as the same single aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from adtally.functions.dates import validate_date, yesterday
from adtally.operators.kpi import REGION
from adtally.functions.rates import rate_sql
from adtally.operators.measures import NONZERO, RATES, measure_sql, measures
from adtally.session import unique_name


def _date_sql(report_date: str | None) -> str:
    return f"'{validate_date(report_date) if report_date else yesterday()}'"


def counts_sql(view: str, dims: Sequence[str], rules: str, report_date: str | None) -> str:
    """report_date, dims, eleven measures per group of ``view``."""
    dim_list = ", ".join(f"t.{d}" for d in dims)
    body = ",\n  ".join(measure_sql(m, "t") for m in measures(rules))
    return (
        f"SELECT {_date_sql(report_date)} AS report_date, {dim_list},\n  {body}\n"
        f"FROM {view} t\nGROUP BY {dim_list}"
    )


def rates_sql(view: str) -> str:
    """All columns of ``view`` plus the three rates, non-zero groups only."""
    rates = ",\n  ".join(f"{rate_sql('t.' + num, 't.' + den)} AS {name}" for name, num, den in RATES)
    where = " AND ".join(f"t.{c} != 0" for c in NONZERO)
    return f"SELECT t.*,\n  {rates}\nFROM {view} t\nWHERE {where}"


def kpi_report_two_step(
    df: DataFrame,
    dims: Sequence[str] = REGION,
    rules: str = "loose",
    report_date: str | None = None,
    view_name: str | None = None,
) -> DataFrame:
    """Register ``df`` as a view, aggregate with SQL, register that, add rates.

    ``view_name`` is honoured (and left registered); by default unique,
    session-private names are used and dropped once the plan is built.
    """
    spark = df.sparkSession
    src = view_name or unique_name("adtally_log")
    mid = unique_name("adtally_counts")
    df.createOrReplaceTempView(src)
    try:
        counts = spark.sql(counts_sql(src, dims, rules, report_date))
        counts.createOrReplaceTempView(mid)
        try:
            return spark.sql(rates_sql(mid))
        finally:
            spark.catalog.dropTempView(mid)
    finally:
        if view_name is None:
            spark.catalog.dropTempView(src)


def kpi_report_cte(
    df: DataFrame,
    dims: Sequence[str] = REGION,
    rules: str = "loose",
    report_date: str | None = None,
    view_name: str | None = None,
) -> DataFrame:
    """The same report as one ``WITH counts AS (...) SELECT ...`` statement."""
    spark = df.sparkSession
    src = view_name or unique_name("adtally_log")
    df.createOrReplaceTempView(src)
    try:
        sql = f"WITH counts AS (\n{counts_sql(src, dims, rules, report_date)}\n)\n{rates_sql('counts')}"
        return spark.sql(sql)
    finally:
        if view_name is None:
            spark.catalog.dropTempView(src)
