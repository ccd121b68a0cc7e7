"""Streaming ETL: file stream of JSON logs -> enriched, partitioned parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from adtally.functions.dates import validate_date
from adtally.operators.enrich import enrich_ips
from adtally.schema import DATED_LOG_SCHEMA


def start_etl_stream(
    spark: SparkSession,
    log_dir: str,
    ip_dictionary: DataFrame,
    output_path: str,
    checkpoint_location: str,
    schema: StructType = DATED_LOG_SCHEMA,
    date_col: str = "date_str",
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    run_date: str | None = None,
    **lookup,
) -> StreamingQuery:
    """Start the query and return its handle.

    Rows keep the event day in ``date_col`` when the log has one; otherwise
    they get ``run_date``, or by default the day before their micro-batch, as
    in the batch job. The parquet file sink plus
    ``checkpoint_location`` (a folder every executor and the driver can
    reach, stable across restarts) give exactly-once output: a restarted
    query resumes from the last committed batch, never duplicating a file.
    The dictionary is validated once, when the query is defined.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    log = reader.json(log_dir)
    enriched = enrich_ips(log, ip_dictionary, **lookup)
    if date_col not in log.columns:
        stamp = F.lit(validate_date(run_date)) if run_date else F.date_sub(F.current_date(), 1).cast("string")
        enriched = enriched.withColumn(date_col, stamp)
    writer = (
        enriched.writeStream.format("parquet")
        .partitionBy(date_col)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(output_path)
