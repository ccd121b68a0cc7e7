"""

Every query reads the driver's parquet tables under ``sf_dir`` (the ad log is
derived from ``events``, the IP dictionary from ``nation`` x ``region``, see
FIXTURES.md) and runs over the whole tables.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally import fixtures as fx
from adtally.functions import ip_to_long
from adtally.operators import (
    dictionary_from_regions,
    enrich_ips,
    kpi_counts,
    kpi_report,
    map_feed,
    region_distribution,
    region_top,
    top_n_by_measure,
    top_n_by_total,
    top_n_per_measure,
)
from adtally.plans import (
    daily_reports,
    daily_sums,
    kpi_report_cte,
    kpi_report_two_step,
    period_reports,
    read_quarantine,
    run_etl,
    run_reports,
    stamp_date,
    store_sums,
    table_output,
)
from adtally.schema import DATED_LOG_SCHEMA, ENRICHED_SCHEMA
from adtally.session import scratch_path, unique_name
from adtally.sinks import upsert_partitions, write_partitions, write_table_partitions
from adtally.sources import read_ad_log, read_day
from adtally.streaming import DictionaryVersions, read_stream_output, start_batched_etl_stream, start_etl_stream

# The training-data operators and their pipeline are an optional part.
# Any import error of theirs, a library that is not installed too, leaves them out.
try:
    import corpus_pipeline
    from adtally.llm import queries as llm_queries
except ImportError as missing:
    logging.getLogger(__name__).warning("without the training-data operators: %s", missing)
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
REGION = ("province", "city")


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.ip_dict_from(spark, sf_dir)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_ips(fx.ad_log_from(spark, sf_dir), _dictionary(spark, sf_dir))


def _enriched_day(spark: SparkSession, sf_dir: str, day: str = fx.DAY) -> DataFrame:
    return enrich_ips(fx.ad_log_from(spark, sf_dir, day), _dictionary(spark, sf_dir))


def _kpi(dims, rules="strict"):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return kpi_report(_enriched(spark, sf_dir), dims, rules, fx.ALL_DAYS_REPORT_DATE)

    return run


def _counts(rules):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return kpi_counts(_enriched(spark, sf_dir), REGION, rules)

    return run


def q_region_kpi_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_report(_enriched(spark, sf_dir), REGION, "strict", fx.ALL_DAYS_REPORT_DATE)


def q_region_kpi_strict_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_report(_enriched_day(spark, sf_dir), REGION, "strict", fx.DAY)


def q_region_kpi_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_report_two_step(_enriched(spark, sf_dir), REGION, "loose", fx.ALL_DAYS_REPORT_DATE)


def q_region_kpi_cte(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_report_cte(_enriched(spark, sf_dir), REGION, "loose", fx.ALL_DAYS_REPORT_DATE)


def q_ip_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


def _nested_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary's ranges under one of all addresses, each with two nested ones."""
    ranges = _dictionary(spark, sf_dir)
    outer, inner = (ranges.selectExpr(f"ip_start + {a} AS ip_start", f"ip_start + {b} AS ip_end", "province", f"concat(city, '{mark}') AS city")
                    for a, b, mark in ((1_000_000, 20_999_999, " A"), (5_000_000, 5_999_999, " B")))
    world = ranges.agg(F.min("ip_start") * 0, F.max("ip_end") * 0 + 4294967295, F.lit("WORLD"), F.lit("WORLD"))
    return ranges.union(outer).union(inner).union(world)


def q_ip_enrich_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_ips(fx.ad_log_from(spark, sf_dir), _nested_dictionary(spark, sf_dir), nested=True).select("uuid", "ip", "province", "city")


def q_ip_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.ad_log_from(spark, sf_dir)
    return log.select("uuid", "ip", ip_to_long("ip").alias("ip_num"))


def q_dict_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary_from_regions(fx.region_strings(fx.ip_dict_from(spark, sf_dir)))


def q_etl_stamp_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp_date(_enriched(spark, sf_dir), fx.ETL_RUN_DATE)


def q_region_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_distribution(_enriched(spark, sf_dir), REGION, fx.ALL_DAYS_REPORT_DATE)


def q_region_distribution_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_distribution(_enriched_day(spark, sf_dir), REGION, fx.DAY)


def q_region_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_top(_enriched(spark, sf_dir), 10, REGION, fx.ALL_DAYS_REPORT_DATE)


def q_top_n_by_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n_by_measure(fx.load(spark, sf_dir, "customer"), "c_custkey", "c_acctbal", 10)


def q_top_n_by_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n_by_total(fx.load(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", 10, "total",
                          exact_type="decimal(18,2)")


TOP_MEASURES = ("ad_show_cnt", "ad_click_cnt", "dsp_pay_money")


def q_top_n_per_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = kpi_counts(_enriched(spark, sf_dir), REGION, "strict")
    return top_n_per_measure(counts, REGION, TOP_MEASURES, 10)


def q_province_map_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = fx.load(spark, sf_dir, "region").select(F.col("r_name").alias("province"))
    # a province without traffic, shown with a zero
    features = features.unionByName(fx.load(spark, sf_dir, "region").select(F.upper(F.concat("r_name", F.lit(" (NO TRAFFIC)"))).alias("province"))
                                    .orderBy("province").limit(1))
    return map_feed(features, _enriched(spark, sf_dir), "province", "events")


def q_city_map_feed_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = fx.load(spark, sf_dir, "nation").select(F.col("n_name").alias("city"))
    return map_feed(features, _enriched_day(spark, sf_dir), "city", "events")


def _json_log(spark: SparkSession, sf_dir: str) -> str:
    """Write the fixture log as JSON lines to the shared scratch area."""
    path = scratch_path(spark, "json-log")
    fx.ad_log_from(spark, sf_dir).drop("ip_num").write.json(path)
    return path


def q_scan_json_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ad_log(spark, _json_log(spark, sf_dir), schema=DATED_LOG_SCHEMA)


def q_scan_partitioned_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON log -> ETL (enrich, keep event day) -> partitioned parquet -> one day."""
    out = scratch_path(spark, "etl")
    run_etl(spark, _json_log(spark, sf_dir), fx.ip_dict_from(spark, sf_dir), out,
            log_schema=DATED_LOG_SCHEMA, stamp=False)
    return read_day(spark, out, fx.DAY)


def q_sink_parquet_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all days twice, then one day again: every day survives, no duplicates."""
    enriched = _enriched(spark, sf_dir)
    out = scratch_path(spark, "parquet-sink")
    write_partitions(enriched, out)
    write_partitions(enriched, out)
    write_partitions(enriched.where(F.col("date_str") == fx.DAY), out)
    schema = enriched.select(*[c for c in enriched.columns if c != "date_str"], "date_str").schema
    return spark.read.schema(schema).parquet(out)


def q_sink_table_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = _enriched(spark, sf_dir)
    table = unique_name("adtally_enriched")
    path = scratch_path(spark, "table-sink")
    write_table_partitions(enriched, table, path=path)
    write_table_partitions(enriched, table)
    write_table_partitions(enriched.where(F.col("date_str") == fx.DAY), table)
    return spark.read.table(table)


def q_report_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert per-day distributions; a stale version of a day is replaced."""
    prev = _enriched_day(spark, sf_dir, fx.PREVIOUS_DAY)
    day = _enriched_day(spark, sf_dir, fx.DAY)
    out = scratch_path(spark, "report-upsert")
    upsert_partitions(region_distribution(prev, REGION, fx.PREVIOUS_DAY), out, REGION)
    upsert_partitions(region_distribution(prev, REGION, fx.DAY), out, REGION)  # stale
    upsert_partitions(region_distribution(day, REGION, fx.DAY), out, REGION)
    schema = region_distribution(day, REGION, fx.DAY).schema
    return spark.read.schema(schema).parquet(out)


#: Of 50 events, one line is cut off and one has a text for a number.
_CUT_LINE = "concat('{\"uuid\":\"u', CAST(event_id AS STRING), '\",\"ip\":')"
_TYPE_LINE = "concat('{\"uuid\":\"u', CAST(event_id AS STRING), '\",\"requestmode\":\"none\"}')"


def q_etl_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with broken lines through the ETL: the readable rows as written, and the
    text of the others from the quarantine."""
    logged = fx.ad_log_from(spark, sf_dir).drop("ip_num")
    number = F.expr("CAST(substring(uuid, 2) AS BIGINT)").alias("event_id")
    lines = logged.select(number, F.to_json(F.struct(*logged.columns)).alias("value")).selectExpr(
        f"CASE event_id % 50 WHEN 7 THEN {_CUT_LINE} WHEN 8 THEN {_TYPE_LINE} ELSE value END AS value")
    path, out, aside = (scratch_path(spark, f"quarantine-{x}") for x in ("log", "fact", "lines"))
    lines.write.text(path)
    run_etl(spark, path, _dictionary(spark, sf_dir), out, run_date=fx.ETL_RUN_DATE, log_schema=DATED_LOG_SCHEMA, stamp=False, quarantine=aside)
    good = spark.read.schema(ENRICHED_SCHEMA).parquet(out).select("uuid", "requestmode", "city", "date_str", F.lit(None).cast("string").alias("line"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in good.dtypes[:3]]
    return good.unionByName(read_quarantine(spark, aside).select(*nothing, F.col("load_date").alias("date_str"), "line"))


def q_report_upsert_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upsert of two days into a history of all days: their rows are replaced,
    the other days are neither read nor written."""
    enriched = _enriched(spark, sf_dir)
    history = enriched.groupBy(F.col("date_str").alias("report_date"), *REGION).count()
    out = scratch_path(spark, "upsert-days")
    upsert_partitions(history, out, REGION)
    days = history.where(F.col("report_date").isin(fx.PREVIOUS_DAY, fx.DAY)).withColumn("count", F.col("count") + 1000)
    upsert_partitions(days, out, REGION)
    return spark.read.schema(history.schema).parquet(out)


def q_stream_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ETL as a file-stream query run to completion (availableNow)."""
    out = scratch_path(spark, "stream-etl")
    query = start_etl_stream(
        spark, _json_log(spark, sf_dir), fx.ip_dict_from(spark, sf_dir), out,
        checkpoint_location=scratch_path(spark, "stream-etl-checkpoint"), available_now=True,
    )
    query.awaitTermination()  # availableNow ends by itself
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.schema(ENRICHED_SCHEMA).parquet(out)


def q_stream_dictionary_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of two files, with a new dictionary between them and the salted
    join: the rows of each file have the cities of its own version."""
    log, out, checkpoint, versions = (scratch_path(spark, f"stream-versions-{x}") for x in ("log", "out", "checkpoint", "dict"))
    events, first = fx.ad_log_from(spark, sf_dir).drop("ip_num"), _dictionary(spark, sf_dir)
    dictionary = DictionaryVersions(spark, versions)
    for part, ranges in ((f"date_str < '{fx.DAY}'", first), (f"date_str >= '{fx.DAY}'", first.withColumn("city", F.concat("city", F.lit(" 2"))))):
        events.where(part).write.mode("append").json(log)
        dictionary.publish(ranges)
        query = start_batched_etl_stream(spark, log, dictionary, out, checkpoint, available_now=True, broadcast=False)
        query.awaitTermination()  # availableNow ends by itself
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    return read_stream_output(spark, out)


def q_kpi_period_from_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region KPI report over all days, from stored daily sums."""
    folder = scratch_path(spark, "daily-sums")
    store_sums(daily_sums(_enriched(spark, sf_dir)), folder, "all")
    return period_reports(spark, folder, fx.FIRST_DAY, fx.ALL_DAYS_REPORT_DATE)["kpi_region"]


def q_late_events_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day in two batches, the late one delivered twice: the report of the whole day."""
    day, folder = _enriched_day(spark, sf_dir), scratch_path(spark, "late-sums")
    late = F.expr("CAST(substring(uuid, 2) AS BIGINT) % 3 = 0")
    for batch, part in (("on-time", ~late), ("late", late), ("late", late)):
        store_sums(daily_sums(day.where(part)), folder, batch)
    return period_reports(spark, folder, fx.DAY, fx.DAY)["kpi_region"]


def q_etl_reports_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs end to end: JSON log -> run_etl into a catalog table ->
    run_reports for one day -> the upserted region KPI report, read back."""
    table = unique_name("adtally_fact")
    run_etl(spark, _json_log(spark, sf_dir), _dictionary(spark, sf_dir), table, to_table=True,
            log_schema=DATED_LOG_SCHEMA, stamp=False, table_path=scratch_path(spark, "fact"))
    out = unique_name("adtally_report")
    run_reports(spark, table, fx.DAY, outputs={"kpi_region": table_output(out, scratch_path(spark, "report"))},
                is_table=True)
    return spark.read.table(out)


def q_daily_kpi_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_reports(_enriched_day(spark, sf_dir), fx.DAY)["kpi_region"]


def q_daily_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_reports(_enriched_day(spark, sf_dir), fx.DAY)["region_distribution"]


def q_daily_kpi_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_reports(_enriched_day(spark, sf_dir), fx.DAY)["kpi_channel"]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: strict region KPI report over the sf0.001 ad log."""
    return q_region_kpi_strict(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _reference_queries()
    if llm_queries is not None:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def _reference_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ip_enrich": q_ip_enrich,
        "ip_enrich_nested": q_ip_enrich_nested,
        "ip_to_long": q_ip_to_long,
        "dict_split": q_dict_split,
        "etl_stamp_date": q_etl_stamp_date,
        "region_distribution": q_region_distribution,
        "region_distribution_day": q_region_distribution_day,
        "kpi_counts_strict": _counts("strict"),
        "kpi_counts_loose": _counts("loose"),
        "region_kpi_strict": q_region_kpi_strict,
        "region_kpi_strict_day": q_region_kpi_strict_day,
        "region_kpi_loose": q_region_kpi_loose,
        "region_kpi_cte": q_region_kpi_cte,
        "kpi_by_app": _kpi(("appname",)),
        "kpi_by_device": _kpi(("device",)),
        "kpi_by_network": _kpi(("network",)),
        "kpi_by_isp": _kpi(("isp",)),
        "kpi_by_channel": _kpi(("channelid",)),
        "region_top10": q_region_top10,
        "top_n_by_measure": q_top_n_by_measure,
        "top_n_by_total": q_top_n_by_total,
        "top_n_per_measure": q_top_n_per_measure,
        "province_map_feed": q_province_map_feed,
        "city_map_feed_day": q_city_map_feed_day,
        "scan_json_log": q_scan_json_log,
        "scan_partitioned_day": q_scan_partitioned_day,
        "sink_parquet_rerun": q_sink_parquet_rerun,
        "sink_table_rerun": q_sink_table_rerun,
        "report_upsert": q_report_upsert,
        "report_upsert_days": q_report_upsert_days,
        "etl_quarantine": q_etl_quarantine,
        "daily_kpi_region": q_daily_kpi_region,
        "daily_distribution": q_daily_distribution,
        "daily_kpi_channel": q_daily_kpi_channel,
        "stream_etl": q_stream_etl,
        "stream_dictionary_versions": q_stream_dictionary_versions,
        "kpi_period_from_sums": q_kpi_period_from_sums,
        "late_events_kpi": q_late_events_kpi,
        "etl_reports_day": q_etl_reports_day,
    }


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). Written by hand, independently of the library code.

_STRICT_MEASURES = """
  CAST(SUM(CASE WHEN requestmode = 1 AND processnode >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS orginal_req_cnt,
  CAST(SUM(CASE WHEN requestmode = 1 AND processnode >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS valid_req_cnt,
  CAST(SUM(CASE WHEN requestmode = 1 AND processnode = 3 THEN 1 ELSE 0 END) AS BIGINT) AS ad_req_cnt,
  CAST(SUM(CASE WHEN adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1
                 AND isbid = 1 AND adorderid <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS join_rtx_cnt,
  CAST(SUM(CASE WHEN adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1
                 AND iswin = 1 AND adorderid <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS success_rtx_cnt,
  CAST(SUM(CASE WHEN requestmode = 2 AND iseffective = 1 THEN 1 ELSE 0 END) AS BIGINT) AS ad_show_cnt,
  CAST(SUM(CASE WHEN requestmode = 3 AND iseffective = 1 AND adorderid <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS ad_click_cnt,
  CAST(SUM(CASE WHEN requestmode = 2 AND iseffective = 1 AND isbilling = 1
                 AND isbid = 1 AND iswin = 1 THEN 1 ELSE 0 END) AS BIGINT) AS media_show_cnt,
  CAST(SUM(CASE WHEN requestmode = 3 AND iseffective = 1 AND isbilling = 1
                 AND isbid = 1 AND iswin = 1 THEN 1 ELSE 0 END) AS BIGINT) AS media_click_cnt,
  CAST(SUM(CASE WHEN adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1
                 AND iswin = 1 AND adorderid > 200000 AND adcreativeid > 200000
                THEN floor(winprice / 1000) ELSE 0 END) AS BIGINT) AS dsp_pay_money,
  CAST(SUM(CASE WHEN adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1
                 AND isbid = 1 AND iswin = 1 AND adorderid > 200000 AND adcreativeid > 200000
                THEN floor(adpayment / 1000) ELSE 0 END) AS BIGINT) AS dsp_cost_money
"""

_LOOSE_MEASURES = """
  CAST(SUM(CASE WHEN requestmode = 1 AND processnode >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS orginal_req_cnt,
  CAST(SUM(CASE WHEN requestmode = 1 AND processnode >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS valid_req_cnt,
  CAST(SUM(CASE WHEN requestmode = 1 AND processnode = 3 THEN 1 ELSE 0 END) AS BIGINT) AS ad_req_cnt,
  CAST(SUM(CASE WHEN adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1
                 AND isbid = 1 AND adorderid <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS join_rtx_cnt,
  CAST(SUM(CASE WHEN adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1
                 AND iswin = 1 THEN 1 ELSE 0 END) AS BIGINT) AS success_rtx_cnt,
  CAST(SUM(CASE WHEN requestmode = 2 AND iseffective = 1 THEN 1 ELSE 0 END) AS BIGINT) AS ad_show_cnt,
  CAST(SUM(CASE WHEN requestmode = 3 AND iseffective = 1 THEN 1 ELSE 0 END) AS BIGINT) AS ad_click_cnt,
  CAST(SUM(CASE WHEN requestmode = 2 AND iseffective = 1 AND isbilling = 1 THEN 1 ELSE 0 END) AS BIGINT) AS media_show_cnt,
  CAST(SUM(CASE WHEN requestmode = 3 AND iseffective = 1 AND isbilling = 1 THEN 1 ELSE 0 END) AS BIGINT) AS media_click_cnt,
  CAST(SUM(CASE WHEN adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1
                 AND iswin = 1 AND adorderid > 200000 AND adcreativeid > 200000
                THEN floor(winprice / 1000) ELSE 0 END) AS BIGINT) AS dsp_pay_money,
  CAST(SUM(CASE WHEN adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1
                 AND iswin = 1 AND adorderid > 200000 AND adcreativeid > 200000
                THEN floor(adpayment / 1000) ELSE 0 END) AS BIGINT) AS dsp_cost_money
"""

# round(a / b, 2) half-up for a, b >= 0, exact in integers (DuckDB's own round
# of the double quotient differs from Spark's on ties such as 29/200).
def _rate(a: str, b: str, name: str) -> str:
    return f"CAST((200 * {a} + {b}) // (2 * {b}) AS DOUBLE) / 100 AS {name}"


_RATES = ",\n  ".join(
    [
        _rate("success_rtx_cnt", "join_rtx_cnt", "success_rtx_rate"),
        _rate("ad_click_cnt", "ad_show_cnt", "ad_click_rate"),
        _rate("media_click_cnt", "media_show_cnt", "media_click_rate"),
    ]
)

_NONZERO = """join_rtx_cnt <> 0 AND success_rtx_cnt <> 0 AND ad_show_cnt <> 0
  AND ad_click_cnt <> 0 AND media_show_cnt <> 0 AND media_click_cnt <> 0"""


def _kpi_sql(dims: str, measures: str, date: str, where: str = "TRUE", date_first: bool = False) -> str:
    date_col = f"'{date}' AS report_date"
    head = f"{date_col}, " if date_first else ""
    tail = "" if date_first else f",\n  {date_col}"
    return fx.with_fixtures(
        f"""
, counts AS (
  SELECT {dims}, {measures}
  FROM enriched WHERE {where}
  GROUP BY {dims}
)
SELECT {head}{dims}, counts.* EXCLUDE ({dims}),
  {_RATES}{tail}
FROM counts
WHERE {_NONZERO}
"""
    )


def _counts_sql(measures: str) -> str:
    return fx.with_fixtures(f"SELECT province, city, {measures} FROM enriched GROUP BY province, city")


def _distribution_sql(date: str, where: str = "TRUE", limit: str = "") -> str:
    return fx.with_fixtures(
        f"""SELECT province, city, count(*) AS count, '{date}' AS report_date
FROM enriched WHERE {where} GROUP BY province, city
ORDER BY count DESC, province NULLS LAST, city NULLS LAST {limit}"""
    )


_ENRICHED_COLS = """uuid, ip, requestmode, processnode, adplatformproviderid, iseffective, isbilling,
  isbid, iswin, adorderid, adcreativeid, winprice, adpayment, appname, device, network, isp,
  channelid, province, city, date_str"""

_LOG_COLS = """uuid, ip, requestmode, processnode, adplatformproviderid, iseffective, isbilling,
  isbid, iswin, adorderid, adcreativeid, winprice, adpayment, appname, device, network, isp,
  channelid, date_str"""

_DAY = f"date_str = '{fx.DAY}'"


def oracle_sql() -> dict[str, str]:
    found = _reference_oracle_sql()
    if llm_queries is not None:
        found |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _reference_oracle_sql() -> dict[str, str]:
    strict, loose = _STRICT_MEASURES, _LOOSE_MEASURES
    all_days = fx.ALL_DAYS_REPORT_DATE
    return {
        "ip_enrich": fx.with_fixtures("SELECT * FROM enriched"),
        "ip_enrich_nested": fx.with_fixtures(
            """, nested AS (
  SELECT ip_start, ip_end, province, city FROM ip_dict
  UNION ALL SELECT ip_start + 1000000, ip_start + 20999999, province, city || ' A' FROM ip_dict
  UNION ALL SELECT ip_start + 5000000, ip_start + 5999999, province, city || ' B' FROM ip_dict
  UNION ALL SELECT 0, 4294967295, 'WORLD', 'WORLD')
SELECT uuid, ip, arg_min(province, d.ip_end - d.ip_start) AS province, arg_min(city, d.ip_end - d.ip_start) AS city
FROM ad_log LEFT JOIN nested d ON ip_num BETWEEN d.ip_start AND d.ip_end GROUP BY uuid, ip"""
        ),
        "ip_to_long": fx.with_fixtures("SELECT uuid, ip, ip_num FROM ad_log"),
        "dict_split": fx.with_fixtures("SELECT ip_start, ip_end, province, city FROM ip_dict"),
        "etl_stamp_date": fx.with_fixtures(
            f"SELECT * REPLACE ('{fx.ETL_RUN_DATE}' AS date_str) FROM enriched"
        ),
        "region_distribution": _distribution_sql(all_days),
        "region_distribution_day": _distribution_sql(fx.DAY, _DAY),
        "kpi_counts_strict": _counts_sql(strict),
        "kpi_counts_loose": _counts_sql(loose),
        "region_kpi_strict": _kpi_sql("province, city", strict, all_days),
        "region_kpi_strict_day": _kpi_sql("province, city", strict, fx.DAY, _DAY),
        "region_kpi_loose": _kpi_sql("province, city", loose, all_days, date_first=True),
        "region_kpi_cte": _kpi_sql("province, city", loose, all_days, date_first=True),
        "kpi_by_app": _kpi_sql("appname", strict, all_days),
        "kpi_by_device": _kpi_sql("device", strict, all_days),
        "kpi_by_network": _kpi_sql("network", strict, all_days),
        "kpi_by_isp": _kpi_sql("isp", strict, all_days),
        "kpi_by_channel": _kpi_sql("channelid", strict, all_days),
        "region_top10": _distribution_sql(all_days, limit="LIMIT 10"),
        "top_n_by_measure": """SELECT c_custkey, c_acctbal FROM customer
ORDER BY c_acctbal DESC NULLS LAST, c_custkey NULLS LAST LIMIT 10""",
        "top_n_by_total": """SELECT o_custkey,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
FROM orders GROUP BY o_custkey
ORDER BY total DESC NULLS LAST, o_custkey NULLS LAST LIMIT 10""",
        "top_n_per_measure": fx.with_fixtures(
            f""", counts AS (SELECT province, city, {strict} FROM enriched GROUP BY province, city),
long AS (
  SELECT province, city, 'ad_show_cnt' AS measure, ad_show_cnt AS value FROM counts
  UNION ALL SELECT province, city, 'ad_click_cnt', ad_click_cnt FROM counts
  UNION ALL SELECT province, city, 'dsp_pay_money', dsp_pay_money FROM counts
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY measure
      ORDER BY value DESC NULLS LAST, province NULLS LAST, city NULLS LAST) AS INTEGER) AS rank
  FROM long
)
SELECT * FROM ranked WHERE rank <= 10"""
        ),
        "province_map_feed": fx.with_fixtures(
            """SELECT r.r_name AS province, CAST(coalesce(t.events, 0) AS BIGINT) AS events
FROM (SELECT DISTINCT r_name FROM region WHERE r_name IS NOT NULL
      UNION ALL SELECT min(upper(r_name || ' (NO TRAFFIC)')) FROM region) r
LEFT JOIN (SELECT province, count(*) AS events FROM enriched
           WHERE province IS NOT NULL GROUP BY province) t ON r.r_name = t.province"""
        ),
        "city_map_feed_day": fx.with_fixtures(
            f"""SELECT n.n_name AS city, CAST(coalesce(t.events, 0) AS BIGINT) AS events
FROM (SELECT DISTINCT n_name FROM nation WHERE n_name IS NOT NULL) n
LEFT JOIN (SELECT city, count(*) AS events FROM enriched
           WHERE city IS NOT NULL AND {_DAY} GROUP BY city) t ON n.n_name = t.city"""
        ),
        "scan_json_log": fx.with_fixtures(f"SELECT {_LOG_COLS} FROM ad_log"),
        "scan_partitioned_day": fx.with_fixtures(f"SELECT {_ENRICHED_COLS} FROM enriched WHERE {_DAY}"),
        "sink_parquet_rerun": fx.with_fixtures("SELECT * FROM enriched"),
        "sink_table_rerun": fx.with_fixtures("SELECT * FROM enriched"),
        # Upsert semantics: the stale copy of DAY (built from PREVIOUS_DAY's
        # rows) survives only for keys the real DAY does not report.
        "report_upsert": fx.with_fixtures(
            f""", prev AS (SELECT province, city, count(*) AS count FROM enriched
              WHERE date_str = '{fx.PREVIOUS_DAY}' GROUP BY province, city),
cur AS (SELECT province, city, count(*) AS count FROM enriched
        WHERE date_str = '{fx.DAY}' GROUP BY province, city)
SELECT province, city, count, '{fx.PREVIOUS_DAY}' AS report_date FROM prev
UNION ALL SELECT province, city, count, '{fx.DAY}' FROM cur
UNION ALL SELECT p.province, p.city, p.count, '{fx.DAY}' FROM prev p
  WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.province IS NOT DISTINCT FROM p.province
                                          AND c.city IS NOT DISTINCT FROM p.city)"""
        ),
        "report_upsert_days": fx.with_fixtures(
            f"""SELECT province, city, date_str AS report_date,
  count(*) + CASE WHEN date_str IN ('{fx.PREVIOUS_DAY}', '{fx.DAY}') THEN 1000 ELSE 0 END AS count
FROM enriched GROUP BY province, city, date_str"""
        ),
        "etl_quarantine": fx.with_fixtures(
            f"""SELECT uuid, requestmode, city, date_str, NULL AS line FROM enriched
WHERE CAST(substr(uuid, 2) AS BIGINT) % 50 NOT IN (7, 8)
UNION ALL SELECT NULL, NULL, NULL, '{fx.ETL_RUN_DATE}',
  '{{"uuid":"u' || event_id || '",' || CASE event_id % 50 WHEN 7 THEN '"ip":' ELSE '"requestmode":"none"}}' END
FROM events WHERE event_id % 50 IN (7, 8)"""
        ),
        "daily_kpi_region": _kpi_sql("province, city", strict, fx.DAY, _DAY),
        "daily_distribution": _distribution_sql(fx.DAY, _DAY),
        "daily_kpi_channel": _kpi_sql("channelid", strict, fx.DAY, _DAY),
        "stream_etl": fx.with_fixtures(f"SELECT {_ENRICHED_COLS} FROM enriched"),
        "stream_dictionary_versions": fx.with_fixtures(
            f"""SELECT {_ENRICHED_COLS.replace("city", f"CASE WHEN date_str < '{fx.DAY}' THEN city ELSE city || ' 2' END AS city")} FROM enriched"""
        ),
        "kpi_period_from_sums": _kpi_sql("province, city", strict, all_days),
        "late_events_kpi": _kpi_sql("province, city", strict, fx.DAY, _DAY),
        "etl_reports_day": _kpi_sql("province, city", strict, fx.DAY, _DAY),
    }
