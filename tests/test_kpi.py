import pytest
from pyspark.sql import functions as F

from adtally import fixtures as fx
from adtally.operators import enrich_ips, kpi_counts, kpi_report
from adtally.operators.measures import MEASURE_NAMES
from adtally.plans import kpi_report_cte, kpi_report_two_step
from adtally.schema import RAW_LOG_SCHEMA

from conftest import SF01

COLS = [f.name for f in RAW_LOG_SCHEMA.fields]


def _row(**kw):
    base = dict(
        uuid="u", ip="1.1.1.1", requestmode=1, processnode=3, adplatformproviderid=100000,
        iseffective=1, isbilling=1, isbid=1, iswin=1, adorderid=250000, adcreativeid=250000,
        winprice=1999.0, adpayment=1000.0, appname="a", device="d", network=0, isp=0, channelid=0,
    )
    base.update(kw)
    return tuple(base[c] for c in COLS)


def _events(spark, rows, province="P", city="C"):
    df = spark.createDataFrame(rows, RAW_LOG_SCHEMA)
    return df.withColumn("province", F.lit(province)).withColumn("city", F.lit(city))


def _one(spark, rows, rules="strict"):
    return kpi_counts(_events(spark, rows), rules=rules).first().asDict()


def test_provider_boundary(spark):
    assert _one(spark, [_row(adplatformproviderid=99999)])["join_rtx_cnt"] == 0
    assert _one(spark, [_row(adplatformproviderid=100000)])["join_rtx_cnt"] == 1


def test_order_and_creative_boundaries(spark):
    assert _one(spark, [_row(adorderid=0)])["join_rtx_cnt"] == 0
    r = _one(spark, [_row(adorderid=200000)])
    assert r["join_rtx_cnt"] == 1 and r["dsp_pay_money"] == 0
    assert _one(spark, [_row(adorderid=200001, adcreativeid=200001)])["dsp_pay_money"] == 1
    assert _one(spark, [_row(adorderid=200001, adcreativeid=200000)])["dsp_pay_money"] == 0


@pytest.mark.parametrize("price,expected", [(999.0, 0), (1000.0, 1), (1999.0, 1), (-1500.0, -2)])
def test_price_is_floored_per_event(spark, price, expected):
    assert _one(spark, [_row(winprice=price)])["dsp_pay_money"] == expected
    # flooring happens before the sum: 2 x 1999 -> 1 + 1, not floor(3.998)
    assert _one(spark, [_row(winprice=1999.0), _row(winprice=1999.0)])["dsp_pay_money"] == 2


def test_null_price_and_all_null_group(spark):
    assert _one(spark, [_row(winprice=None), _row(winprice=1000.0)])["dsp_pay_money"] == 1
    assert _one(spark, [_row(winprice=None)])["dsp_pay_money"] is None
    # a false condition contributes 0 even with a NULL price
    assert _one(spark, [_row(winprice=None, iswin=0)])["dsp_pay_money"] == 0


def test_null_flag_counts_as_zero(spark):
    r = _one(spark, [_row(isbid=None)])
    assert r["join_rtx_cnt"] == 0 and r["success_rtx_cnt"] == 1


def test_strict_and_loose_differ_where_documented(spark):
    row = [_row(adorderid=0, isbid=0, requestmode=3)]
    s, l = _one(spark, row, "strict"), _one(spark, row, "loose")
    assert (s["success_rtx_cnt"], l["success_rtx_cnt"]) == (0, 1)
    assert (s["ad_click_cnt"], l["ad_click_cnt"]) == (0, 1)
    assert (s["media_click_cnt"], l["media_click_cnt"]) == (0, 1)
    row = [_row(isbid=0)]
    assert (_one(spark, row, "strict")["dsp_cost_money"], _one(spark, row, "loose")["dsp_cost_money"]) == (0, 1)


def test_rates_round_half_up(spark):
    # 29/200 = 0.145 -> 0.15 ; 205/200 = 1.025 -> 1.03
    df = spark.createDataFrame([(29, 200), (205, 200)], "a bigint, b bigint")
    from adtally.functions import rate

    got = [r[0] for r in df.select(rate("a", "b")).collect()]
    assert got == [0.15, 1.03]
    assert df.select(rate("a", "a - a")).first()[0] is None


@pytest.fixture(scope="module")
def enriched01(spark):
    df = enrich_ips(fx.ad_log_from(spark, SF01), fx.ip_dict_from(spark, SF01))
    return df.cache()


GOLD = {
    "strict": [3331, 2221, 1108, 3793, 3828, 2930, 2332, 1761, 1749, 5546, 6454],
    "loose": [3331, 2221, 1108, 3793, 4770, 2930, 2914, 2566, 2553, 5546, 7507],
}


@pytest.mark.parametrize("rules", ["strict", "loose"])
def test_golden_totals(enriched01, rules):
    counts = kpi_counts(enriched01, rules=rules)
    totals = counts.agg(*[F.sum(m).alias(m) for m in MEASURE_NAMES]).first()
    assert [totals[m] for m in MEASURE_NAMES] == GOLD[rules]


def test_golden_region_and_app(enriched01):
    r = kpi_report(enriched01, report_date="2024-01-30").where(
        (F.col("province") == "AFRICA") & (F.col("city") == "NATION_0")
    ).first()
    assert [r[m] for m in MEASURE_NAMES] == [119, 80, 38, 132, 139, 104, 81, 62, 62, 169, 210]
    a = kpi_report(enriched01, ("appname",), report_date="2024-01-30").where(F.col("appname") == "click").first()
    assert [a[m] for m in MEASURE_NAMES] == [635, 430, 208, 752, 753, 584, 490, 338, 359, 1132, 1276]
    assert (a["success_rtx_rate"], a["ad_click_rate"], a["media_click_rate"]) == (1.0, 0.84, 1.06)


def test_enrichment_golden_counts(enriched01):
    per = {r["province"]: r["count"] for r in enriched01.groupBy("province").count().collect()}
    assert per == {"AFRICA": 1736, "AMERICA": 1726, "ASIA": 1739, "EUROPE": 1735, "MIDDLE EAST": 1736, None: 1328}
    assert enriched01.count() == 10000


def test_column_orders(enriched01):
    strict = kpi_report(enriched01, report_date="2024-01-30")
    assert strict.columns[:2] == ["province", "city"] and strict.columns[-1] == "report_date"
    loose = kpi_report_two_step(enriched01, report_date="2024-01-30")
    assert loose.columns[:3] == ["report_date", "province", "city"]


def test_three_forms_agree(enriched01):
    def rows(df):
        return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())

    for rules in ("strict", "loose"):
        dsl = kpi_report(enriched01, rules=rules, report_date="2024-01-30")
        two = kpi_report_two_step(enriched01, rules=rules, report_date="2024-01-30")
        cte = kpi_report_cte(enriched01, rules=rules, report_date="2024-01-30")
        assert rows(dsl) == rows(two) == rows(cte)


def test_strict_never_exceeds_loose(enriched01):
    s = {(r["province"], r["city"]): r for r in kpi_counts(enriched01, rules="strict").collect()}
    l = {(r["province"], r["city"]): r for r in kpi_counts(enriched01, rules="loose").collect()}
    assert s.keys() == l.keys()
    for k in s:
        for m in MEASURE_NAMES:
            assert s[k][m] <= l[k][m], (k, m)


def test_named_view_is_honoured(spark, enriched01):
    kpi_report_two_step(enriched01, view_name="my_day_view", report_date="2024-01-30")
    assert spark.catalog.tableExists("my_day_view")
    spark.catalog.dropTempView("my_day_view")


def test_single_aggregation_shuffle(enriched01):
    plan = kpi_report(enriched01, report_date="2024-01-30")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2  # partial + final


def test_dimension_that_is_also_a_measure_input(enriched01):
    out = kpi_counts(enriched01, ("requestmode",))
    assert sorted(r["requestmode"] for r in out.collect()) == [1, 2, 3]
