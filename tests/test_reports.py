from pyspark.sql import functions as F

from adtally import fixtures as fx
from adtally.operators import (
    enrich_ips,
    map_feed,
    region_distribution,
    region_top,
    top_n_by_measure,
    top_n_by_total,
    top_n_per_measure,
)

from conftest import SF001, SF01


def _enriched(spark, sf=SF01):
    return enrich_ips(fx.ad_log_from(spark, sf), fx.ip_dict_from(spark, sf))


def test_distribution_sums_to_input(spark):
    e = _enriched(spark)
    d = region_distribution(e, report_date="2024-01-30")
    assert d.agg(F.sum("count")).first()[0] == e.count()
    rows = d.collect()
    assert len(rows) == 26
    assert (rows[0]["province"], rows[0]["count"]) == (None, 1328)
    assert (rows[1]["province"], rows[1]["city"], rows[1]["count"]) == ("ASIA", "NATION_12", 350)
    assert d.columns == ["province", "city", "count", "report_date"]


def test_top10_is_top_k_plan_and_deterministic(spark):
    top = region_top(_enriched(spark), 10, report_date="2024-01-30")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    a = [tuple(r) for r in top.collect()]
    b = [tuple(r) for r in region_top(_enriched(spark), 10, report_date="2024-01-30").collect()]
    assert a == b and len(a) == 10


def test_top_n_by_measure_and_total(spark):
    cust = fx.load(spark, SF01, "customer")
    top = top_n_by_measure(cust, "c_custkey", "c_acctbal", 10).collect()
    best = cust.orderBy(F.desc("c_acctbal"), "c_custkey").limit(10).collect()
    assert [r["c_custkey"] for r in top] == [r["c_custkey"] for r in best]
    tot = top_n_by_total(fx.load(spark, SF01, "orders"), "o_custkey", "o_totalprice", 10, exact_type="decimal(18,2)")
    assert dict(tot.dtypes)["total"] == "decimal(18,2)"
    vals = [r["total"] for r in tot.collect()]
    assert vals == sorted(vals, reverse=True)


def test_top_n_per_measure_ranks(spark):
    df = spark.createDataFrame(
        [(k, float(k % 7), float(-k)) for k in range(100)], "k bigint, a double, b double"
    )
    out = top_n_per_measure(df, "k", ["a", "b"], 3)
    got = {(r["measure"], r["rank"]): r["k"] for r in out.collect()}
    assert got[("a", 1)] == 6 and got[("a", 2)] == 13 and got[("b", 1)] == 0
    assert out.count() == 6


def test_totals_are_not_rounded_by_default(spark):
    df = spark.createDataFrame([("small", 0.004)] * 1000 + [("one", 1.0)], "k string, v double")
    top = top_n_by_total(df, "k", "v", 2).collect()
    assert top[0]["k"] == "small" and abs(top[0]["total"] - 4.0) < 1e-9


def test_top_n_keeps_large_values_and_list_keys(spark):
    df = spark.createDataFrame([("p1", "same", 2**53), ("p2", "same", 2**53 + 1)], "province string, city string, n bigint")
    top = top_n_per_measure(df, ["province", "city"], ["n"], 2).orderBy("rank").collect()
    assert [(r["province"], r["city"], r["value"]) for r in top] == [("p2", "same", 2**53 + 1), ("p1", "same", 2**53)]


def test_map_feed_fills_zero(spark):
    features = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "province string")
    ev = spark.createDataFrame([("A",), ("A",), ("B",), (None,), ("Z",)], "province string")
    got = {r["province"]: r["events"] for r in map_feed(features, ev).collect()}
    assert got == {"A": 2, "B": 1, "C": 0}


def test_city_map_feed_has_every_nation(spark):
    nations = fx.load(spark, SF001, "nation").select(F.col("n_name").alias("city"))
    day = _enriched(spark, SF001).where(F.col("date_str") == fx.DAY)
    feed = map_feed(nations, day, "city")
    assert feed.count() == 25
    assert feed.agg(F.sum("events")).first()[0] == day.where(F.col("city").isNotNull()).count()


def test_map_feed_with_name_mapping(spark):
    features = spark.createDataFrame([("Hainan",), ("Hebei",), ("Tibet",)], "province string")
    ev = spark.createDataFrame(
        [("Hainan Province",), ("Hainan Province",), ("Hebei",), ("Hebei Province",)], "province string"
    )
    names = spark.createDataFrame(
        [("Hainan Province", "Hainan"), ("Hebei Province", "Hebei")], "source string, target string"
    )
    got = {r["province"]: r["events"] for r in map_feed(features, ev, names=names).collect()}
    assert got == {"Hainan": 2, "Hebei": 2, "Tibet": 0}
