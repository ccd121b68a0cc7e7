import pytest
from pyspark.sql import functions as F

from adtally.functions import ip_to_long, long_to_ip, region_parts

CASES = [
    ("0.0.0.0", 0),
    ("255.255.255.255", 4294967295),
    ("221.222.21.59", 3722319163),
    ("1.2.3.4", 16909060),
    ("256.1.1.1", None),
    ("1.2.3", None),
    ("1.2.3.4.5", None),
    ("", None),
    (None, None),
    ("bad-ip", None),
    (" 1.2.3.4", None),
    ("1.2.3.-4", None),
]


def test_ip_to_long_literals(spark):
    df = spark.createDataFrame([(ip,) for ip, _ in CASES], "ip string")
    got = {r["ip"]: r["n"] for r in df.select("ip", ip_to_long("ip").alias("n")).collect()}
    for ip, expected in CASES:
        assert got[ip] == expected, ip


def test_long_to_ip_round_trip(spark):
    nums = [0, 1, 255, 256, 16909060, 3722319163, 4294967295, None]
    df = spark.createDataFrame([(n,) for n in nums], "n bigint")
    with_ip = df.select("n", long_to_ip("n").alias("ip"))
    rows = with_ip.select("n", "ip", ip_to_long("ip").alias("back")).collect()
    for r in rows:
        assert r["back"] == r["n"]
    assert {r["n"]: r["ip"] for r in rows}[3722319163] == "221.222.21.59"


def test_region_parts(spark):
    rows = [
        ("China|0|Hainan|Haikou|Edu",),
        ("X|0|AFRICA|NATION_0|isp",),
        ("too|short",),
        ("a|b|c|d|e|f",),
        (None,),
    ]
    df = spark.createDataFrame(rows, "region string")
    p, c = region_parts("region")
    got = [tuple(r) for r in df.select(p.alias("p"), c.alias("c")).collect()]
    assert got == [("Hainan", "Haikou"), ("AFRICA", "NATION_0"), (None, None), (None, None), (None, None)]
