"""Property tests (hypothesis) for the IP codec and the range lookup."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adtally.functions import ip_to_long, long_to_ip
from adtally.operators import range_lookup

IP = st.integers(min_value=0, max_value=(1 << 32) - 1)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(IP, min_size=1, max_size=200))
def test_ip_round_trip(spark, nums):
    df = spark.createDataFrame([(n,) for n in nums], "n bigint")
    back = df.withColumn("ip", long_to_ip("n")).select(ip_to_long("ip").alias("m"), "n").collect()
    assert all(r["m"] == r["n"] for r in back)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(IP, min_size=2, max_size=60, unique=True),
    st.lists(IP, min_size=1, max_size=200),
)
def test_lookup_keeps_rows_and_matches_brute_force(spark, cuts, keys):
    cuts = sorted(cuts)
    ranges = [(cuts[i], cuts[i + 1] - 1, f"p{i}", f"c{i}") for i in range(0, len(cuts) - 1, 2)]
    d = spark.createDataFrame(ranges, "ip_start bigint, ip_end bigint, province string, city string")
    ev = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id bigint, k bigint")
    got = {r["id"]: r["province"] for r in range_lookup(ev, "k", d).collect()}
    assert len(got) == len(keys)
    for i, k in enumerate(keys):
        hit = [p for s, e, p, _ in ranges if s <= k <= e]
        assert got[i] == (hit[0] if hit else None)
