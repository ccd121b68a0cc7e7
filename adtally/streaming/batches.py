"""The ETL stream with a dictionary that changes and addresses that are hot.

Each micro-batch is enriched as a batch of its own (``foreachBatch``), so that what
a stream-static join cannot do is done per batch: the buckets with very many rows
are counted and salted as in the batch job, and the dictionary is the version that
is current when the batch begins.

Exactly once: what a batch depends on besides its rows (dictionary version and run
date) is written to the checkpoint folder before the batch is, and a rerun of the
batch takes it from there; its rows go to folders of the batch's number, which a
rerun replaces.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from adtally.errors import OverlappingRangesError
from adtally.functions.dates import validate_date, yesterday
from adtally.operators.enrich import enrich_ips
from adtally.operators.nested_ranges import disjoint_ranges
from adtally.operators.range_join import DictionaryStats, dictionary_stats
from adtally.schema import DATED_LOG_SCHEMA, ENRICHED_SCHEMA

BATCH_COLUMN = "batch_id"
_PAYLOAD = ["province", "city"]


class DictionaryVersions:
    """An IP dictionary in numbered versions, a folder each under ``folder``. A
    version is whole and never changes; it counts once its write is complete."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, version: int) -> str:
        return f"{self.folder}/version={version}"

    def complete(self) -> list[int]:
        """The numbers of all complete versions, ascending."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.folder)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = fs.globStatus(hadoop.Path(root, "version=*/_SUCCESS")) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)

    def publish(self, dictionary: DataFrame) -> int:
        """Write a new version and return its number. One writer at a time: a
        second one with the same number fails."""
        version = (self.complete() or [0])[-1] + 1
        dictionary.select("ip_start", "ip_end", *_PAYLOAD).write.mode("errorifexists").parquet(self._path(version))
        return version

    def latest(self) -> int:
        versions = self.complete()
        if not versions:
            raise FileNotFoundError(f"no complete dictionary version under {self.folder}")
        return versions[-1]

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(self._path(version))


class _BatchLog:
    """What each batch was made with: a one-row file per batch in the checkpoint folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/adtally_batches"

    def get(self, batch_id: int) -> tuple[int, str] | None:
        try:
            row = self.spark.read.schema("version long, run_date string").json(f"{self.folder}/{BATCH_COLUMN}={batch_id}").first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return (row["version"], row["run_date"]) if row else None

    def put(self, batch_id: int, version: int, run_date: str) -> None:
        row = self.spark.createDataFrame([(version, run_date)], "version long, run_date string")
        row.coalesce(1).write.mode("overwrite").json(f"{self.folder}/{BATCH_COLUMN}={batch_id}")


def start_batched_etl_stream(
    spark: SparkSession,
    log_dir: str,
    dictionary: DataFrame | DictionaryVersions,
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
    """Start the query and return its handle; read the output with
    :func:`read_stream_output`.

    Arguments are those of :func:`start_etl_stream`. A ``DictionaryVersions`` is
    looked up at every batch; each version is validated once per run of the query,
    and an invalid one fails the batch before it is noted for it, so that a
    corrected version mends the stream. ``lookup`` goes to ``range_lookup``.
    """
    if run_date:
        validate_date(run_date)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    log = reader.json(log_dir)
    batches = _BatchLog(spark, checkpoint_location)
    versioned = isinstance(dictionary, DictionaryVersions)
    nested = lookup.pop("nested", False)
    ready: dict[int, tuple[DataFrame, DictionaryStats]] = {}

    def at_version(version: int) -> tuple[DataFrame, DictionaryStats]:
        if version not in ready:
            ranges = dictionary.read(version) if versioned else dictionary
            if nested:
                ranges = disjoint_ranges(ranges.select("ip_start", "ip_end", *_PAYLOAD))
            stats = dictionary_stats(ranges, payload=_PAYLOAD)
            if stats.overlaps or stats.malformed:
                raise OverlappingRangesError(f"dictionary version {version} has {stats.overlaps} overlapping pair(s) and {stats.malformed} malformed range(s)")
            ready.clear()  # a stream goes forward: one version at a time
            ready[version] = ranges, stats
        return ready[version]

    def handle(rows: DataFrame, batch_id: int) -> None:
        known = batches.get(batch_id)
        version, day = known or (dictionary.latest() if versioned else 0, run_date or yesterday())
        ranges, stats = at_version(version)
        if known is None:
            batches.put(batch_id, version, day)
        # The rows are counted by bucket and then joined: parsed once for both.
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            enriched = enrich_ips(rows, ranges, stats=stats, **lookup)
            if date_col not in log.columns:
                enriched = enriched.withColumn(date_col, F.lit(day))
            enriched = enriched.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))
            writer = enriched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(date_col, BATCH_COLUMN).parquet(output_path)
        finally:
            rows.unpersist()

    writer = log.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location).outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_stream_output(spark: SparkSession, output_path: str, schema: StructType = ENRICHED_SCHEMA, date_col: str = "date_str") -> DataFrame:
    """The rows that :func:`start_batched_etl_stream` has written, without the batch number."""
    body = [f for f in schema.fields if f.name != date_col]
    layout = StructType([*body, schema[date_col]]).add(BATCH_COLUMN, "long")
    return spark.read.schema(layout).parquet(output_path).select(*schema.fieldNames())
