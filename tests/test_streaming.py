"""Streaming ETL: exactly-once output across restarts on one checkpoint."""

import pytest
from pyspark.sql import functions as F

from adtally import fixtures as fx
from adtally.schema import DATED_LOG_SCHEMA, ENRICHED_SCHEMA, RAW_LOG_SCHEMA
from adtally.session import scratch_path
from adtally.operators import enrich_ips
from adtally.streaming import DictionaryVersions, read_stream_output, start_batched_etl_stream, start_etl_stream

from conftest import SF001


def _run(spark, log_dir, out, ckpt):
    q = start_etl_stream(spark, log_dir, fx.ip_dict_from(spark, SF001), out,
                         checkpoint_location=ckpt, available_now=True)
    assert q.awaitTermination(600), "stream did not finish"
    assert q.exception() is None


def test_restart_resumes_without_duplicates(spark):
    log = fx.ad_log_from(spark, SF001).drop("ip_num")
    first = log.where(F.col("date_str") < "2024-01-15")
    second = log.where(F.col("date_str") >= "2024-01-15")
    log_dir = scratch_path(spark, "t-stream-log")
    out, ckpt = scratch_path(spark, "t-stream-out"), scratch_path(spark, "t-stream-ckpt")

    first.write.mode("append").json(log_dir)
    _run(spark, log_dir, out, ckpt)
    n1 = spark.read.schema(ENRICHED_SCHEMA).parquet(out).count()
    assert n1 == first.count()

    _run(spark, log_dir, out, ckpt)  # restart, nothing new: no change
    assert spark.read.schema(ENRICHED_SCHEMA).parquet(out).count() == n1

    second.write.mode("append").json(log_dir)  # new files land
    _run(spark, log_dir, out, ckpt)
    back = spark.read.schema(ENRICHED_SCHEMA).parquet(out)
    assert back.count() == log.count()
    assert back.select("uuid").distinct().count() == log.count()


def _batched(spark, log_dir, dictionary, out, ckpt, **more):
    q = start_batched_etl_stream(spark, log_dir, dictionary, out, ckpt, available_now=True, **more)
    assert q.awaitTermination(300), "stream did not finish"
    if q.exception() is not None:
        raise q.exception()


def _paths(spark, name):
    return [scratch_path(spark, f"t-{name}-{x}") for x in ("log", "out", "ckpt")]


def _sorted(df):
    return sorted(map(tuple, df.select(*ENRICHED_SCHEMA.fieldNames()).collect()), key=str)


def test_hot_address_in_a_stream_equals_the_batch(spark):
    log_dir, out, ckpt = _paths(spark, "hot")
    log = fx.ad_log_from(spark, SF001).drop("ip_num").withColumn("ip", F.expr("CASE WHEN substring(uuid, 2) % 3 = 0 THEN '0.0.0.9' ELSE ip END"))
    log.write.json(log_dir)
    d = fx.ip_dict_from(spark, SF001)
    _batched(spark, log_dir, d, out, ckpt, broadcast=False)
    got = read_stream_output(spark, out)
    assert got.columns == ENRICHED_SCHEMA.fieldNames()
    assert _sorted(got) == _sorted(enrich_ips(spark.read.schema(DATED_LOG_SCHEMA).json(log_dir), d))


def test_only_measured_buckets_are_replicated(spark):
    from adtally.operators.range_join import _B, _LV, _S, _salted, explode_ranges

    d = spark.createDataFrame([(i << 16, (i << 16) + 9, "p", f"c{i}") for i in range(100)], "ip_start bigint, ip_end bigint, province string, city string")
    events = spark.createDataFrame([(i, (5 << 16) + 1 if i % 3 == 0 else (i % 100) << 16) for i in range(900)], "id bigint, _rl_key bigint")
    probe = events.withColumn(_B, F.shiftright("_rl_key", 16)).withColumn(_LV, F.lit(0))
    dim = explode_ranges(d, "ip_start", "ip_end", ["city"], 16).withColumn(_LV, F.lit(0))
    _, salted = _salted(events, probe, dim)
    rows = {r[0]: r["count"] for r in salted.groupBy(_B).count().collect()}
    assert rows.pop(5) > 1 and set(rows.values()) == {1}
    assert salted.select(_S).distinct().count() > 1


def test_dictionary_versions_between_batches(spark):
    log_dir, out, ckpt = _paths(spark, "versions")
    versions = DictionaryVersions(spark, scratch_path(spark, "t-dict-versions"))
    with pytest.raises(FileNotFoundError):
        versions.latest()
    row = lambda uuid: spark.createDataFrame([(uuid, "0.0.0.5", "2024-01-01")], "uuid string, ip string, date_str string")
    ranges = lambda city: spark.createDataFrame([(0, 9, "p", city)], "ip_start bigint, ip_end bigint, province string, city string")
    assert versions.publish(ranges("old")) == 1
    row("a").write.mode("append").json(log_dir)
    _batched(spark, log_dir, versions, out, ckpt)
    assert versions.publish(ranges("new")) == 2 and versions.complete() == [1, 2]
    row("b").write.mode("append").json(log_dir)
    _batched(spark, log_dir, versions, out, ckpt)
    cities = lambda: {r["uuid"]: r["city"] for r in read_stream_output(spark, out).collect()}
    assert cities() == {"a": "old", "b": "new"}
    # A batch that was written but not committed is run again, with its own version.
    hadoop = spark._jvm.org.apache.hadoop.fs
    commits = hadoop.Path(f"{ckpt}/commits")
    fs = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.delete(hadoop.Path(commits, "1"), False)
    versions.publish(ranges("newest"))
    _batched(spark, log_dir, versions, out, ckpt)
    assert cities() == {"a": "old", "b": "new"} and read_stream_output(spark, out).count() == 2


def test_invalid_version_fails_and_a_new_one_mends(spark):
    log_dir, out, ckpt = _paths(spark, "invalid")
    versions = DictionaryVersions(spark, scratch_path(spark, "t-dict-invalid"))
    schema = "ip_start bigint, ip_end bigint, province string, city string"
    versions.publish(spark.createDataFrame([(0, 9, "p", "a"), (5, 20, "p", "b")], schema))
    spark.createDataFrame([("a", "0.0.0.7")], "uuid string, ip string").write.json(log_dir)
    with pytest.raises(Exception, match="overlapping"):
        _batched(spark, log_dir, versions, out, ckpt, schema=RAW_LOG_SCHEMA, run_date="2024-01-01")
    versions.publish(spark.createDataFrame([(0, 9, "p", "a"), (5, 8, "p", "b")], schema))
    _batched(spark, log_dir, versions, out, ckpt, schema=RAW_LOG_SCHEMA, run_date="2024-01-01", nested=True)
    assert [(r["city"], r["date_str"]) for r in read_stream_output(spark, out).collect()] == [("b", "2024-01-01")]
