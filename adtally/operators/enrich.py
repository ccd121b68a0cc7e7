"""IP geolocation of ad events: dotted quad -> number -> dictionary range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.ip import ip_to_long, region_parts
from adtally.operators.range_join import range_lookup


def dictionary_from_regions(
    df: DataFrame, region: str = "region", start: str = "ip_start", end: str = "ip_end"
) -> DataFrame:
    """(ip_start, ip_end, 'country|x|province|city|isp') -> (ip_start, ip_end, province, city)."""
    province, city = region_parts(region)
    return df.select(
        F.col(start).cast("bigint").alias("ip_start"),
        F.col(end).cast("bigint").alias("ip_end"),
        province.alias("province"),
        city.alias("city"),
    )


def enrich_ips(log: DataFrame, ip_dictionary: DataFrame, ip_col: str = "ip", **lookup) -> DataFrame:
    """Append ``province`` and ``city`` to every log row.

    Rows are never dropped or duplicated: a NULL, malformed or unknown IP keeps
    its row with NULL province/city. ``lookup`` is passed to ``range_lookup``
    (bucket width, broadcast budget, salt).
    """
    return range_lookup(
        log,
        ip_to_long(ip_col),
        ip_dictionary.select("ip_start", "ip_end", "province", "city"),
        start="ip_start",
        end="ip_end",
        payload=("province", "city"),
        **lookup,
    )
