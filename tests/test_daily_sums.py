"""Reports from stored daily sums against reports from the events."""

import pytest
from pyspark.sql import functions as F

from adtally import fixtures as fx
from adtally.errors import EmptyDayError
from adtally.operators import enrich_ips, kpi_report, region_distribution
from adtally.operators.kpi import DIMENSIONS
from adtally.plans import daily_sums, period_reports, read_sums, store_sums
from adtally.schema import ENRICHED_SCHEMA
from adtally.session import scratch_path

from conftest import SF001


@pytest.fixture(scope="module")
def enriched(spark):
    return enrich_ips(fx.ad_log_from(spark, SF001), fx.ip_dict_from(spark, SF001)).cache()


@pytest.fixture(scope="module")
def stored(spark, enriched):
    folder = scratch_path(spark, "t-sums")
    for rules in ("strict", "loose"):
        store_sums(daily_sums(enriched, rules), folder, "all", rules)
    return folder


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("rules", ["strict", "loose"])
def test_month_equals_the_direct_reports(spark, enriched, stored, rules):
    made = period_reports(spark, stored, "2024-01-01", "2024-01-30", rules=rules)
    assert _rows(made["region_distribution"]) == _rows(region_distribution(enriched, report_date="2024-01-30"))
    for name, dims in DIMENSIONS.items():
        direct = kpi_report(enriched, dims, rules, "2024-01-30")
        assert made[f"kpi_{name}"].columns == direct.columns
        assert _rows(made[f"kpi_{name}"]) == _rows(direct), name


def test_plan_reads_the_days_sums_and_no_event(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = period_reports(spark, stored, "2024-01-10", "2024-01-12")["kpi_app"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("FileScan") == 1 and "t-sums" in plan
    filters = plan.split("PartitionFilters: [")[1]
    assert "report_date" in filters and "2024-01-10" in filters and "report" in filters


def test_some_days(spark, enriched, stored):
    days = enriched.where(F.col("date_str").between("2024-01-03", "2024-01-09"))
    made = period_reports(spark, stored, "2024-01-03", "2024-01-09", report_date="2024-02-01")
    assert _rows(made["kpi_device"]) == _rows(kpi_report(days, ("device",), report_date="2024-02-01"))
    assert made["region_top10"].count() == 10


def test_late_batch_adds_once(spark, enriched):
    folder = scratch_path(spark, "t-late")
    late = F.col("date_str").isin("2024-01-03", "2024-01-04") & (F.expr("substring(uuid, 2) % 4") == 0)
    store_sums(daily_sums(enriched.where(~late)), folder, "b1")
    first = read_sums(spark, folder, "app", "2024-01-01", "2024-01-30").agg(F.sum("count")).first()[0]
    for _ in range(2):
        store_sums(daily_sums(enriched.where(late)), folder, "b2")
    total = read_sums(spark, folder, "app", "2024-01-01", "2024-01-30").agg(F.sum("count")).first()[0]
    assert first < total == enriched.count()
    assert _rows(period_reports(spark, folder, "2024-01-01", "2024-01-30")["kpi_region"]) == _rows(kpi_report(enriched, report_date="2024-01-30"))
    # a corrected batch replaces all that it had stored, on days that it no longer has too
    store_sums(daily_sums(enriched.where(late & (F.col("date_str") == "2024-01-03"))), folder, "b2")
    assert read_sums(spark, folder, "app", "2024-01-04", "2024-01-04").agg(F.sum("count")).first()[0] == enriched.where((F.col("date_str") == "2024-01-04") & ~late).count()


def test_null_sums_and_zero_counters_are_judged_after_adding(spark):
    base = {c: None for c in ENRICHED_SCHEMA.fieldNames()}
    paid = dict(adplatformproviderid=100000, iseffective=1, isbilling=1, isbid=1, iswin=1, adorderid=200001, adcreativeid=200001, requestmode=2, processnode=1)
    rows = [base | paid | {"date_str": "2024-01-01", "province": "p"}, base | paid | {"date_str": "2024-01-02", "province": "p", "winprice": 2500.0},
            base | paid | {"date_str": "2024-01-02", "province": "p", "requestmode": 3}, base | {"date_str": "2024-01-01"}]
    events = spark.createDataFrame([tuple(r[c] for c in ENRICHED_SCHEMA.fieldNames()) for r in rows], ENRICHED_SCHEMA)
    folder = scratch_path(spark, "t-null-sums")
    store_sums(daily_sums(events), folder, "x")
    day = read_sums(spark, folder, "region", "2024-01-01", "2024-01-01").where("province = 'p'").first()
    assert day["dsp_pay_money"] is None and day["count"] == 1
    month = period_reports(spark, folder, "2024-01-01", "2024-01-02")["kpi_region"]
    assert _rows(month) == _rows(kpi_report(events, report_date="2024-01-02"))
    both = month.collect()
    assert len(both) == 1 and both[0]["dsp_pay_money"] == 2 and not period_reports(spark, folder, "2024-01-01", "2024-01-01")["kpi_region"].count()


def test_errors(spark, stored):
    with pytest.raises(EmptyDayError):
        period_reports(spark, stored, "2023-01-01", "2023-01-02")
    with pytest.raises(ValueError):
        store_sums(spark.createDataFrame([(1,)], "x int"), stored, "a/b")
    with pytest.raises(ValueError):
        read_sums(spark, stored, "app", "2024-1-1", "2024-01-02")
    with pytest.raises(ValueError):
        read_sums(spark, stored, "app", "2024-01-01", "2024-01-02", rules="x")


def test_command_line_sums_and_period(spark, enriched):
    from adtally.__main__ import main

    fact, sums, out = (scratch_path(spark, f"t-cli-{x}") for x in ("fact", "sums", "period"))
    enriched.select(*ENRICHED_SCHEMA.fieldNames()).write.partitionBy("date_str").parquet(fact)
    for day in ("2024-01-14", "2024-01-15", "2024-01-15"):
        assert main(["sums", "--source", fact, "--date", day, "--sums", sums], spark=spark) == 0
    assert main(["period", "--sums", sums, "--first", "2024-01-14", "--last", "2024-01-15", "--output", out], spark=spark) == 0
    two = enriched.where(F.col("date_str").isin("2024-01-14", "2024-01-15"))
    back = spark.read.parquet(f"{out}/region_distribution")
    assert back.agg(F.sum("count")).first()[0] == two.count()
