"""Explicit schemas: JSON inference sorts columns, costs a pass over the data
and turns one malformed line into an extra ``_corrupt_record`` column."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# One ad event as it arrives in the JSON log.
RAW_LOG_FIELDS = [
    StructField("uuid", StringType()),
    StructField("ip", StringType()),
    StructField("requestmode", LongType()),
    StructField("processnode", LongType()),
    StructField("adplatformproviderid", LongType()),
    StructField("iseffective", IntegerType()),
    StructField("isbilling", IntegerType()),
    StructField("isbid", IntegerType()),
    StructField("iswin", IntegerType()),
    StructField("adorderid", LongType()),
    StructField("adcreativeid", LongType()),
    StructField("winprice", DoubleType()),
    StructField("adpayment", DoubleType()),
    StructField("appname", StringType()),
    StructField("device", StringType()),
    StructField("network", LongType()),
    StructField("isp", LongType()),
    StructField("channelid", LongType()),
]
RAW_LOG_SCHEMA = StructType(RAW_LOG_FIELDS)

# A log that already carries its event day (as the fixture log does).
DATED_LOG_SCHEMA = StructType(RAW_LOG_FIELDS + [StructField("date_str", StringType())])

# The enriched, date-partitioned fact table.
ENRICHED_SCHEMA = StructType(
    RAW_LOG_FIELDS
    + [
        StructField("province", StringType()),
        StructField("city", StringType()),
        StructField("date_str", StringType()),
    ]
)
