"""Report-date handling: one explicit date per run, `yyyy-MM-dd` text."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "%Y-%m-%d"


def validate_date(date: str) -> str:
    """Return ``date`` if it is a real `yyyy-MM-dd` date, else raise ValueError."""
    parsed = _dt.datetime.strptime(date, DATE_FORMAT).date()
    text = parsed.strftime(DATE_FORMAT)
    if text != date:
        raise ValueError(f"report date must be yyyy-MM-dd, got {date!r}")
    return date


def today(now: _dt.date | None = None) -> str:
    """Today as `yyyy-MM-dd` text, computed once on the driver."""
    return (now or _dt.date.today()).strftime(DATE_FORMAT)


def yesterday(now: _dt.date | None = None) -> str:
    """Yesterday as `yyyy-MM-dd` text, computed once on the driver."""
    now = now or _dt.date.today()
    return (now - _dt.timedelta(days=1)).strftime(DATE_FORMAT)


def report_date_col(date: str | None = None) -> Column:
    """Literal report date. ``None`` means yesterday, fixed once per call so a
    run crossing midnight never mixes two days."""
    return F.lit(validate_date(date) if date is not None else yesterday())
