"""Ratios reported with two decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: rates are rounded half-up to two decimal places.
RATE_SCALE = 2


def rate_sql(numerator: str, denominator: str) -> str:
    return (
        f"round(try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE)), {RATE_SCALE})"
    )


def rate(numerator: str, denominator: str) -> Column:
    """round(numerator / denominator, 2); NULL when the denominator is 0.

    ``try_divide`` keeps the expression safe under ANSI mode even if a caller
    computes rates before (or without) the non-zero filter.
    """
    return F.expr(rate_sql(numerator, denominator))
