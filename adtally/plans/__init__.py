"""Jobs (ETL, reports) and the SQL forms of the KPI report."""

from adtally.plans.daily_sums import daily_sums, period_reports, read_sums, store_sums
from adtally.plans.jobs import (
    daily_reports,
    deliver,
    read_quarantine,
    run_etl,
    run_reports,
    separate_reports,
    stamp_date,
    table_output,
)
from adtally.plans.sql_forms import kpi_report_cte, kpi_report_two_step

__all__ = [
    "daily_reports",
    "daily_sums",
    "deliver",
    "kpi_report_cte",
    "kpi_report_two_step",
    "period_reports",
    "read_quarantine",
    "read_sums",
    "run_etl",
    "run_reports",
    "separate_reports",
    "stamp_date",
    "store_sums",
    "table_output",
]
