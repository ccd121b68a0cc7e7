import os
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

import __spark_entry__ as entry
from adtally import fixtures as fx
from adtally.errors import DuplicateKeyError, EmptyDayError
from adtally.operators import enrich_ips, kpi_report, region_distribution
from adtally.plans import daily_reports, read_quarantine, run_etl, run_reports, separate_reports
from adtally.schema import DATED_LOG_SCHEMA, ENRICHED_SCHEMA
from adtally.session import scratch_path, unique_name
from adtally.sinks import upsert_partitions, write_partitions, write_table_partitions
from adtally.sources import read_ad_log, read_day

from conftest import SF001


@pytest.fixture(scope="module")
def enriched(spark):
    return enrich_ips(fx.ad_log_from(spark, SF001), fx.ip_dict_from(spark, SF001)).cache()


def _rows(df):
    rows = [tuple(r) for r in df.select(sorted(df.columns)).collect()]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_partition_rerun_keeps_other_days(spark, enriched):
    out = scratch_path(spark, "t-parquet")
    write_partitions(enriched, out)
    write_partitions(enriched.where(F.col("date_str") == fx.DAY), out)
    write_partitions(enriched.where(F.col("date_str") == fx.DAY), out)
    back = spark.read.schema(enriched.select(*[c for c in enriched.columns if c != "date_str"], "date_str").schema).parquet(out)
    assert back.count() == enriched.count()
    assert back.select("date_str").distinct().count() == 30


def test_table_append_doubles_but_overwrite_does_not(spark, enriched):
    t1, t2 = unique_name("t_append"), unique_name("t_dyn")
    write_table_partitions(enriched, t1, path=scratch_path(spark, "t1"), append=True)
    write_table_partitions(enriched, t1, append=True)
    assert spark.read.table(t1).count() == 2 * enriched.count()
    write_table_partitions(enriched, t2, path=scratch_path(spark, "t2"))
    write_table_partitions(enriched.where(F.col("date_str") == fx.DAY), t2)
    assert spark.read.table(t2).count() == enriched.count()
    # the caller's session setting is restored
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_upsert_replaces_by_null_safe_key(spark, enriched):
    out = scratch_path(spark, "t-upsert")
    day = enriched.where(F.col("date_str") == fx.DAY)
    d = region_distribution(day, report_date=fx.DAY)
    stale = d.withColumn("count", F.col("count") + 1000)
    upsert_partitions(stale, out, ["province", "city"])
    upsert_partitions(d, out, ["province", "city"])
    upsert_partitions(d, out, ["province", "city"])
    back = spark.read.schema(d.schema).parquet(out)
    assert _rows(back) == _rows(d)
    assert back.where(F.col("province").isNull()).count() == 1


def test_json_scan_modes(spark):
    path = scratch_path(spark, "t-json")
    spark.createDataFrame(
        [('{"uuid":"a","ip":"1.2.3.4","requestmode":1}',), ("not json",), ('{"uuid":"b"}',)], "value string"
    ).write.text(path)
    assert read_ad_log(spark, path).count() == 3
    assert read_ad_log(spark, path, mode="DROPMALFORMED").count() == 2
    with_bad = read_ad_log(spark, path, corrupt_column="_bad")
    bad = with_bad.select("uuid", "_bad").collect()  # not only the corrupt column
    assert [r["_bad"] for r in bad if r["_bad"] is not None] == ["not json"]


def test_etl_then_reports_end_to_end(spark, enriched):
    log = scratch_path(spark, "t-log")
    fx.ad_log_from(spark, SF001).drop("ip_num").write.json(log)
    out = scratch_path(spark, "t-etl")
    run_etl(spark, log, fx.ip_dict_from(spark, SF001), out, log_schema=DATED_LOG_SCHEMA, stamp=False)
    day = read_day(spark, out, fx.DAY)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_str" in plan and fx.DAY in plan
    assert day.count() == 26

    reports_dir = scratch_path(spark, "t-reports")
    outputs = {"kpi_region": f"{reports_dir}/kpi_region", "region_distribution": f"{reports_dir}/dist"}
    fused = run_reports(spark, out, fx.DAY, outputs=outputs)
    with separate_reports(spark, out, fx.DAY) as plain:
        assert "InMemoryTableScan" in plain["kpi_app"]._jdf.queryExecution().executedPlan().toString()
        for name in ("region_distribution", "region_top10", "kpi_region", "kpi_app", "kpi_channel"):
            assert _rows(fused[name]) == _rows(plain[name]), name
    got = []
    run_reports(spark, out, fx.DAY, {"kpi_app": lambda report, keys: got.append((report.count(), list(keys)))})
    assert got == [(fused["kpi_app"].count(), ["appname"])]
    back = spark.read.schema(fused["kpi_region"].schema).parquet(outputs["kpi_region"])
    assert _rows(back) == _rows(fused["kpi_region"])
    with pytest.raises(EmptyDayError):
        run_reports(spark, out, "2023-12-31")


def test_etl_stamps_run_date(spark):
    log = scratch_path(spark, "t-log2")
    fx.ad_log_from(spark, SF001).drop("ip_num", "date_str").write.json(log)
    out = scratch_path(spark, "t-etl2")
    run_etl(spark, log, fx.ip_dict_from(spark, SF001), out, run_date="2024-02-01")
    back = spark.read.schema(ENRICHED_SCHEMA).parquet(out)
    assert [r[0] for r in back.select("date_str").distinct().collect()] == ["2024-02-01"]
    with pytest.raises(ValueError):
        run_etl(spark, log, fx.ip_dict_from(spark, SF001), out, run_date="2024-2-1")


def test_daily_reports_match_individual(spark, enriched):
    day = enriched.where(F.col("date_str") == fx.DAY)
    reps = daily_reports(day, fx.DAY)
    assert _rows(reps["kpi_region"]) == _rows(kpi_report(day, report_date=fx.DAY))
    assert _rows(reps["kpi_device"]) == _rows(kpi_report(day, ("device",), report_date=fx.DAY))
    assert _rows(reps["region_distribution"]) == _rows(region_distribution(day, report_date=fx.DAY))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 25
    assert set(entry.queries()) >= set(entry.oracle_sql())


def test_merge_statement_text():
    from adtally.sinks.jdbc import merge_statement

    sql = merge_statement("rpt", "rpt_staging", ["report_date", "province", "city"],
                          ["report_date", "province", "city", "count"])
    assert sql == (
        'MERGE INTO rpt t USING rpt_staging s ON t."report_date" = s."report_date" AND '
        't."province" = s."province" AND t."city" = s."city" WHEN MATCHED THEN UPDATE SET "count" = s."count" '
        'WHEN NOT MATCHED THEN INSERT ("report_date", "province", "city", "count") '
        'VALUES (s."report_date", s."province", s."city", s."count")'
    )


def test_dates():
    import datetime as dt

    from adtally.functions.dates import today, validate_date, yesterday

    assert today(dt.date(2024, 3, 1)) == "2024-03-01"
    assert yesterday(dt.date(2024, 3, 1)) == "2024-02-29"
    with pytest.raises(ValueError):
        validate_date("2024-02-30")


def test_read_day_from_catalog_table_prunes(spark, enriched):
    table = unique_name("t_day")
    write_table_partitions(enriched.select(*ENRICHED_SCHEMA.fieldNames()), table,
                           path=scratch_path(spark, "t-day"))
    day = read_day(spark, table, fx.DAY, is_table=True)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_str" in plan
    assert day.count() == enriched.where(F.col("date_str") == fx.DAY).count()
    assert dict(day.dtypes)["date_str"] == "string"


def test_command_line_entry_points(spark, tmp_path):
    from adtally.__main__ import main

    log = scratch_path(spark, "t-cli-log")
    fx.ad_log_from(spark, SF001).drop("ip_num", "date_str").write.json(log)
    dictionary = scratch_path(spark, "t-cli-dict")
    fx.region_strings(fx.ip_dict_from(spark, SF001)).write.parquet(dictionary)
    # relative paths (in the JVM's working folder), as in the README
    base = os.path.relpath(tmp_path, os.getcwd())
    out, reports = f"{base}/ENRICHED", f"{base}/REPORTS"
    assert main(["etl", "--log", log, "--dictionary", dictionary, "--output", out,
                 "--date", "2024-02-01"], spark=spark) == 0
    assert main(["reports", "--source", out, "--date", "2024-02-01", "--output", reports],
                spark=spark) == 0
    dist = spark.read.parquet(f"{reports}/region_distribution")
    assert dist.agg(F.sum("count")).first()[0] == 1000

    table, report = unique_name("t_cli"), unique_name("t_cli_rep")
    assert main(["etl", "--log", log, "--dictionary", dictionary, "--output", table, "--table",
                 "--table-path", scratch_path(spark, "t-cli-table"), "--date", "2024-02-01"], spark=spark) == 0
    assert main(["reports", "--source", table, "--table", "--date", "2024-02-01", "--output", report,
                 "--table-path", scratch_path(spark, "t-cli-reports")], spark=spark) == 0
    assert spark.read.table(f"{report}_region_distribution").agg(F.sum("count")).first()[0] == 1000


def test_etl_keeps_every_log_column_and_large_ids(spark):
    log = scratch_path(spark, "t-wide")
    spark.createDataFrame([('{"uuid":"a","ip":"1.2.3.4","adorderid":3000000000,"sessionid":"s1"}',)], "value string").write.text(log)
    schema = StructType([*DATED_LOG_SCHEMA.fields, StructField("sessionid", StringType())])
    out = scratch_path(spark, "t-wide-out")
    run_etl(spark, log, fx.ip_dict_from(spark, SF001), out, run_date="2024-02-01", log_schema=schema)
    row = spark.read.parquet(out).first()
    assert row["sessionid"] == "s1" and row["adorderid"] == 3000000000
    assert spark.read.parquet(out).columns[-1] == "date_str"


def test_upsert_rejects_two_rows_of_one_key(spark):
    df = spark.createDataFrame([("2024-01-01", "p", 1), ("2024-01-01", "p", 2)], "report_date string, province string, count int")
    with pytest.raises(DuplicateKeyError):
        upsert_partitions(df, scratch_path(spark, "t-twice"), ["province"])


def test_upsert_passes_other_errors_on(spark):
    path = scratch_path(spark, "t-broken")
    spark.createDataFrame([("x",)], "value string").write.text(path)
    df = spark.createDataFrame([("2024-01-01", "p", 1)], "report_date string, province string, count int")
    with pytest.raises(Exception):  # a folder that is no report table is not an empty one
        upsert_partitions(df, path, ["province"])


def test_merge_statements():
    from adtally.sinks.jdbc import merge_statement

    ansi = merge_statement("t", "s1", ["province"], ["province", "count"], "jdbc:postgresql://h/d")
    assert ansi == ('MERGE INTO t t USING s1 s ON t."province" = s."province" WHEN MATCHED THEN UPDATE SET "count" = s."count" '
                    'WHEN NOT MATCHED THEN INSERT ("province", "count") VALUES (s."province", s."count")')
    mysql = merge_statement("t", "s1", ["province"], ["province", "count"], "jdbc:mysql://h/d")
    assert mysql == ("INSERT INTO t (`province`, `count`) SELECT s.`province`, s.`count` FROM s1 s "
                     "ON DUPLICATE KEY UPDATE `count` = s.`count`")
    assert "UPDATE SET" not in merge_statement("t", "s1", ["a"], ["a"])
    assert merge_statement("t", "s1", ["a"], ["a"], "jdbc:mysql:x").endswith("UPDATE `a` = s.`a`")


def test_upsert_into_catalog_table(spark, enriched):
    table = unique_name("t_rpt")
    day = enriched.where(F.col("date_str") == fx.DAY)
    d = region_distribution(day, report_date=fx.DAY)
    upsert_partitions(d.withColumn("count", F.lit(0).cast("bigint")), table, ["province", "city"],
                      is_table=True, table_path=scratch_path(spark, "t-rpt"))
    upsert_partitions(d, table, ["province", "city"], is_table=True)
    back = spark.read.table(table)
    assert _rows(back) == _rows(d)


def test_json_schema_inference_sorts_columns(spark):
    path = scratch_path(spark, "t-json-infer")
    fx.ad_log_from(spark, SF001).drop("ip_num").write.json(path)
    inferred = read_ad_log(spark, path, schema=None)
    assert inferred.columns == sorted(inferred.columns)  # inference orders by name
    assert inferred.count() == 1000
    assert dict(inferred.dtypes)["requestmode"] == "bigint"


def test_etl_parse_mode(spark):
    log = scratch_path(spark, "t-mode")
    spark.createDataFrame([('{"uuid":"a","ip":"1.2.3.4"}',), ("not json",)], "value string").write.text(log)
    d = fx.ip_dict_from(spark, SF001)
    kept = run_etl(spark, log, d, scratch_path(spark, "t-mode-out"), run_date="2024-02-01", mode="PERMISSIVE")
    assert kept.count() == 2
    dropped = run_etl(spark, log, d, scratch_path(spark, "t-mode-out2"), run_date="2024-02-01",
                      mode="DROPMALFORMED")
    assert dropped.count() == 1


def test_null_key_placeholder(spark):
    from adtally.sinks.jdbc import with_null_key

    df = spark.createDataFrame([(None, "c", 1), ("p", None, 2)], "province string, city string, count bigint")
    out = with_null_key(df, ["province", "city"], "unknown").collect()
    assert [tuple(r) for r in out] == [("unknown", "c", 1), ("p", "unknown", 2)]


def test_daily_reports_loose_rules_match_individual(spark, enriched):
    day = enriched.where(F.col("date_str") == fx.DAY)
    reps = daily_reports(day, fx.DAY, rules="loose")
    single = kpi_report(day, ("appname",), rules="loose", report_date=fx.DAY)
    assert reps["kpi_app"].columns == single.columns  # date first under the loose form
    assert _rows(reps["kpi_app"]) == _rows(single)


def test_rebalanced_backfill_write(spark, enriched):
    import glob

    plain, balanced = scratch_path(spark, "t-plain"), scratch_path(spark, "t-rebal")
    write_partitions(enriched, plain)
    write_partitions(enriched, balanced, rebalance=True)
    n_plain = len(glob.glob(plain.replace("file:", "") + "/date_str=*/*.parquet"))
    n_bal = len(glob.glob(balanced.replace("file:", "") + "/date_str=*/*.parquet"))
    assert n_bal <= n_plain
    schema = enriched.select(*[c for c in enriched.columns if c != "date_str"], "date_str").schema
    assert _rows(spark.read.schema(schema).parquet(balanced)) == _rows(spark.read.schema(schema).parquet(plain))


BROKEN_LOG = ['{"uuid":"a","ip":"1.2.3.4","requestmode":1}', "not json", '{"uuid":"b","requestmode":"x"}', "", '{"uuid":"c"', '{"uuid":"d"}', "not json"]


def _broken_log(spark, lines=BROKEN_LOG):
    path = scratch_path(spark, "t-broken-log")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    return path


def test_broken_lines_go_to_the_quarantine(spark):
    d, out, aside = fx.ip_dict_from(spark, SF001), scratch_path(spark, "t-q-out"), scratch_path(spark, "t-q")
    seen = Observation()
    run_etl(spark, _broken_log(spark), d, out, run_date="2024-02-01", quarantine=aside, observation=seen)
    assert seen.get == {"rows": 2, "broken": 4}
    assert sorted(r["uuid"] for r in spark.read.parquet(out).collect()) == ["a", "d"]
    rows = read_quarantine(spark, aside).collect()
    assert sorted(r["line"] for r in rows) == sorted(['{"uuid":"b","requestmode":"x"}', '{"uuid":"c"', "not json", "not json"])
    assert {r["load_date"] for r in rows} == {"2024-02-01"} and all("t-broken-log" in r["file"] for r in rows)
    # another day is added, a rerun of a day replaces it, also by nothing
    run_etl(spark, _broken_log(spark, ["?"]), d, out, run_date="2024-02-02", quarantine=aside)
    assert read_quarantine(spark, aside).count() == 5
    run_etl(spark, _broken_log(spark, ['{"uuid":"e"}']), d, out, run_date="2024-02-01", quarantine=aside)
    assert [r["line"] for r in read_quarantine(spark, aside).collect()] == ["?"]


def test_broken_lines_are_left_out_unless_asked_for(spark):
    d, out, seen = fx.ip_dict_from(spark, SF001), scratch_path(spark, "t-left-out"), Observation()
    run_etl(spark, _broken_log(spark), d, out, run_date="2024-02-01", observation=seen)
    assert spark.read.parquet(out).count() == 2 and seen.get["broken"] == 4
    with pytest.raises(ValueError):
        run_etl(spark, _broken_log(spark), d, out, mode="PERMISSIVE", quarantine=out)


def test_quarantine_with_an_inferred_schema(spark):
    d = fx.ip_dict_from(spark, SF001)
    for lines, broken in ((BROKEN_LOG, 3), (['{"uuid":"a","ip":"1.2.3.4"}', '{"uuid":"b","more":1,"ip":null}'], 0)):
        seen, out = Observation(), scratch_path(spark, "t-infer-out")
        run_etl(spark, _broken_log(spark, lines), d, out, run_date="2024-02-01", log_schema=None, observation=seen, quarantine=scratch_path(spark, "t-infer-q"))
        assert seen.get["broken"] == broken
        assert spark.read.parquet(out).count() == len([x for x in lines if x]) - broken


def test_command_line_quarantine(spark):
    from adtally.__main__ import main

    dictionary, out, aside = (scratch_path(spark, f"t-cli-q-{x}") for x in ("dict", "out", "aside"))
    fx.ip_dict_from(spark, SF001).write.parquet(dictionary)
    args = ["etl", "--log", _broken_log(spark), "--dictionary", dictionary, "--output", out, "--date", "2024-02-01", "--quarantine", aside]
    assert main(args, spark=spark) == 0
    assert spark.read.parquet(out).count() == 2 and read_quarantine(spark, aside).count() == 4
    assert main([*args, "--infer-schema"], spark=spark) == 0  # requestmode is text then
    assert spark.read.parquet(out).count() == 3 and read_quarantine(spark, aside).count() == 3


def test_upsert_reads_only_touched_partitions(spark):
    from adtally.sinks.upsert import touched_rows

    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    history = spark.createDataFrame([(d, p, 1) for d in days for p in ("p", "q", None)], "report_date string, province string, count int")
    out = scratch_path(spark, "t-touched")
    upsert_partitions(history, out, ["province"])
    new = spark.createDataFrame([("2024-01-03", "p", 7), ("2024-01-04", None, 8), ("2024-01-20", "p", 9)], history.schema)
    old = touched_rows(spark.read.schema(history.schema).parquet(out), new, "report_date")
    plan = old._jdf.queryExecution().executedPlan().toString()
    listed = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert " IN (" in listed and all(d in listed for d in ("2024-01-03", "2024-01-04", "2024-01-20"))
    assert "Join" not in plan and old.count() == 6
    upsert_partitions(new, out, ["province"])
    back = {(r["report_date"], r["province"]): r["count"] for r in spark.read.schema(history.schema).parquet(out).collect()}
    assert len(back) == 31 and back["2024-01-03", "p"] == 7 and back["2024-01-04", None] == 8 and back["2024-01-20", "p"] == 9
    assert sum(back.values()) == 28 + 7 + 8 + 9


def test_touched_partitions_beyond_a_list(spark, monkeypatch):
    from adtally.sinks import upsert

    monkeypatch.setattr(upsert, "LISTED_PARTITIONS", 1)
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "d string, n int")
    new = spark.createDataFrame([("a", 0), (None, 0)], "d string, n int")
    assert sorted(r["n"] for r in upsert.touched_rows(old, new, "d").collect()) == [1, 3]
    monkeypatch.setattr(upsert, "LISTED_PARTITIONS", 5)
    assert sorted(r["n"] for r in upsert.touched_rows(old, new, "d").collect()) == [1, 3]
