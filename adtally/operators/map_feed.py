"""Feed for a choropleth map: every map feature with its total, 0 without traffic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_feed(
    features: DataFrame,
    events: DataFrame,
    key: str = "province",
    value: str = "events",
    names: DataFrame | None = None,
) -> DataFrame:
    """``features`` lists the map's names in column ``key``; ``events`` are the
    rows to count. Events with a NULL or unknown ``key`` are not on the map.

    ``names`` optionally maps event names to map names (columns ``source``,
    ``target``), for dictionaries whose names differ from the map's (e.g. a
    suffix); unmapped names pass through unchanged.

    The events are aggregated first (partial aggregation, then one row per
    name), so the joins only ever see one small row per name.
    """
    # No NULL filter on the events: the join drops the NULL group anyway, and
    # a filter here would turn an upstream left join into an inner one.
    totals = events.groupBy(key).agg(F.count(F.lit(1)).alias(value))
    if names is not None:
        mapped = totals.join(names, totals[key] == names["source"], "left").select(
            F.coalesce(F.col("target"), F.col(key)).alias(key), F.col(value)
        )
        totals = mapped.groupBy(key).agg(F.sum(value).alias(value))
    feature_names = features.select(key).where(F.col(key).isNotNull()).distinct()
    return feature_names.join(totals, key, "left").select(
        key, F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias(value)
    )
