"""Reading the JSON-lines ad log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from adtally.schema import RAW_LOG_SCHEMA


def read_ad_log(
    spark: SparkSession,
    path: str,
    schema: StructType | None = RAW_LOG_SCHEMA,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read JSON lines with an explicit schema (``schema=None`` infers).

    ``mode`` is Spark's parse mode: PERMISSIVE keeps a malformed line as a row
    of NULLs (and its text in ``corrupt_column`` if given), DROPMALFORMED
    drops it, FAILFAST fails the job.
    """
    reader = spark.read.option("mode", mode)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        if corrupt_column:
            schema = StructType(list(schema.fields)).add(corrupt_column, StringType())
        reader = reader.schema(schema)
    log = reader.json(path)
    if corrupt_column and corrupt_column not in log.columns:  # inferred, and every line is sound
        log = log.withColumn(corrupt_column, F.lit(None).cast("string"))
    return log


#: Column of the log that holds the text of a line that could not be read.
BROKEN = "_broken_line"


def is_broken() -> Column:
    return F.col(BROKEN).isNotNull()


def read_split_log(spark: SparkSession, path: str, schema: StructType | str | None = RAW_LOG_SCHEMA) -> DataFrame:
    """The log with the text of every line that is no JSON object of the schema
    (or has a value of another type) in ``BROKEN``, null for the others. Blank
    lines are no lines. Spark parses only the columns that a query uses: a value of
    a wrong type counts only in a query that uses its column, as the ETL does all."""
    return read_ad_log(spark, path, schema, "PERMISSIVE", BROKEN)


def sound_rows(log: DataFrame) -> DataFrame:
    """The rows of a split log that could be read, with the log's own columns."""
    return log.where(~is_broken()).drop(BROKEN)


def broken_lines(log: DataFrame) -> DataFrame:
    """(line, file) of the lines of a split log that could not be read."""
    own = [c for c in log.columns if c != BROKEN]
    found = log.where(is_broken())
    if own:
        # Always true, but not to the optimizer: only the columns that a query asks
        # for are parsed, and only a parsed value can be of a wrong type.
        found = found.where(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in own]))) > 0)
    return found.select(F.col(BROKEN).alias("line"), F.col("_metadata.file_path").alias("file"))
