"""Top-n lists: by a measure, by a summed measure, and per measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType


def top_n_by_measure(df: DataFrame, key: str, measure: str, n: int = 10) -> DataFrame:
    """The ``n`` rows with the largest ``measure`` (ties: smaller ``key`` first).

    ``orderBy().limit()`` is planned as TakeOrderedAndProject: each task keeps
    its own top n, so only n rows per task reach the final merge.
    """
    return (
        df.select(key, measure)
        .orderBy(F.desc_nulls_last(measure), F.asc_nulls_last(key))
        .limit(n)
    )


def top_n_by_total(
    df: DataFrame,
    key: str,
    measure: str,
    n: int = 10,
    total: str = "total",
    exact_type: str | None = None,
) -> DataFrame:
    """Sum ``measure`` per ``key``, keep the ``n`` largest totals.

    With ``exact_type`` (which the caller chooses, as it rounds every value)
    each value is cast to that decimal before summing, so the total does not
    depend on the order of summation, as floating-point sums do; the
    aggregation is partial before the shuffle either way.
    """
    value = F.col(measure).cast(exact_type) if exact_type else F.col(measure)
    agg = F.sum(value)
    if exact_type:
        agg = agg.cast(exact_type)
    return (
        df.groupBy(key)
        .agg(agg.alias(total))
        .orderBy(F.desc_nulls_last(total), F.asc_nulls_last(key))
        .limit(n)
    )


def _value_type(df: DataFrame, measures: Sequence[str]) -> str:
    """One type that holds every measure exactly, where there is one."""
    types = [df.schema[m].dataType for m in measures]
    if any(isinstance(t, FractionalType) and not isinstance(t, DecimalType) for t in types):
        return "double"
    if not any(isinstance(t, DecimalType) for t in types):
        return "bigint"
    scale = max(t.scale if isinstance(t, DecimalType) else 0 for t in types)
    whole = max(t.precision - t.scale if isinstance(t, DecimalType) else 19 for t in types)
    return f"decimal({min(38, whole + scale)},{scale})"


def top_n_per_measure(
    df: DataFrame, key: str | Sequence[str], measures: Sequence[str], n: int = 10, value_type: str | None = None
) -> DataFrame:
    """One top-n list per measure column, in long form (measure, rank, key..., value).

    ``key`` is a column or a list of them. ``value_type`` defaults to a type
    that keeps all measures exact (bigint, or a decimal; double only if a
    measure is floating-point). The measures are unpivoted and ranked with
    ``row_number`` per measure; the ``rank <= n`` filter lets Spark insert a
    partial window-group limit before the shuffle, so each measure's partition
    receives at most n rows per task even though a measure holds
    1/len(measures) of all rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    value_type = value_type or _value_type(df, measures)
    long = df.select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("measure"), F.col(m).cast(value_type).alias("value"))
                    for m in measures
                ]
            )
        ).alias("mv"),
    ).select(*keys, "mv.measure", "mv.value")
    w = Window.partitionBy("measure").orderBy(F.desc_nulls_last("value"), *[F.asc_nulls_last(k) for k in keys])
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
