import random

import pytest
from pyspark.sql import functions as F

from adtally.errors import OverlappingRangesError
from adtally.operators import dictionary_stats, range_lookup
from adtally.operators.range_join import refinement_levels

RANGES = [(0, 9, "p0", "c0"), (20, 29, "p1", "c1"), (30, 30, "p2", "c2"), (1 << 20, (1 << 21) - 1, "p3", "c3")]


def _dict(spark, rows=RANGES):
    return spark.createDataFrame(rows, "ip_start bigint, ip_end bigint, province string, city string")


def _brute(keys, ranges):
    out = []
    for k in keys:
        hit = [(p, c) for s, e, p, c in ranges if k is not None and s <= k <= e]
        assert len(hit) <= 1
        out.append((k, *(hit[0] if hit else (None, None))))
    return sorted(out, key=lambda t: (t[0] is None, t[0] or 0))


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("bits", [None, 4, 16])
def test_edges_gaps_and_nulls(spark, broadcast, bits):
    keys = [0, 9, 10, 19, 20, 29, 30, 31, (1 << 20) - 1, 1 << 20, (1 << 21) - 1, 1 << 21, None, 4294967295]
    ev = spark.createDataFrame([(k,) for k in keys], "k bigint")
    out = range_lookup(ev, "k", _dict(spark), broadcast=broadcast, bucket_bits=bits)
    got = sorted((tuple(r) for r in out.collect()), key=lambda t: (t[0] is None, t[0] or 0))
    assert got == _brute(keys, RANGES)


def test_random_against_brute_force(spark):
    rnd = random.Random(7)
    cuts = sorted(rnd.sample(range(1, 1 << 32), 400))
    ranges = []
    for i in range(0, len(cuts) - 1, 2):  # every other interval -> gaps between
        ranges.append((cuts[i], cuts[i + 1] - 1, f"p{i % 5}", f"c{i}"))
    keys = [rnd.randrange(0, 1 << 32) for _ in range(3000)] + [s for s, *_ in ranges[:50]] + [e for _, e, *_ in ranges[:50]]
    ev = spark.createDataFrame([(k,) for k in keys], "k bigint")
    d = _dict(spark, ranges)
    for broadcast in (True, False):
        out = range_lookup(ev, "k", d, broadcast=broadcast)
        got = sorted(tuple(r) for r in out.collect())
        assert got == sorted(_brute(keys, ranges))


def test_hot_key_keeps_every_row(spark):
    # One IP holds a third of the rows; the salted shuffle path spreads it.
    rows = [(i, 25 if i % 3 == 0 else i % 20) for i in range(3000)]
    ev = spark.createDataFrame(rows, "id bigint, k bigint")
    out = range_lookup(ev, "k", _dict(spark), broadcast=False)
    assert out.count() == 3000
    assert out.where(F.col("k") == 25).where(F.col("province") == "p1").count() == 1000


def test_null_keys_and_nested_maps_on_the_shuffle_path(spark):
    rows = [(i, None if i % 3 == 0 else 25, {"m": {"a": i}}) for i in range(900)]
    ev = spark.createDataFrame(rows, "id bigint, k bigint, s struct<m: map<string, int>>")
    out = range_lookup(ev, "k", _dict(spark), broadcast=False).collect()
    assert len(out) == 900
    assert sum(r["province"] == "p1" for r in out) == 600 and sum(r["province"] is None for r in out) == 300


def test_small_even_blocks_need_no_refinement(spark):
    # one range per bucket at the chosen width, many per wider bucket
    d = spark.range(4000).selectExpr("id * 256 AS ip_start", "id * 256 + 255 AS ip_end", "'p' AS province", "'c' AS city")
    st = dictionary_stats(d, payload=["province", "city"])
    bits = st.bucket_bits()
    assert bits == 8 and st.density[bits] == 1
    assert refinement_levels(d, "ip_start", "ip_end", bits, 32, st) == []


def test_payload_is_measured_in_bytes(spark):
    st = dictionary_stats(_dict(spark, [(0, 9, "\u6d77\u5357\u7701", "\u6d77\u53e3\u5e02")]), payload=["province", "city"])
    assert st.payload_bytes == 18


def test_overlap_and_malformed_are_rejected(spark):
    ev = spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(OverlappingRangesError):
        range_lookup(ev, "k", _dict(spark, RANGES + [(25, 35, "x", "y")]))
    with pytest.raises(OverlappingRangesError):
        range_lookup(ev, "k", _dict(spark, RANGES + [(50, 40, "x", "y")]))
    with pytest.raises(OverlappingRangesError):
        range_lookup(ev, "k", _dict(spark, RANGES + [(0, 9, "dup", "dup")]))


def test_stats_and_width(spark):
    st = dictionary_stats(_dict(spark), payload=["province", "city"])
    assert st.ranges == 4 and st.overlaps == 0 and st.malformed == 0
    assert st.exploded_rows[20] == 4  # every range lies inside one 2^20 bucket
    assert st.exploded_rows[8] == 3 + 4096
    assert st.bucket_bits() == 8


def test_plan_is_hash_join_not_nested_loop(spark):
    ev = spark.createDataFrame([(k,) for k in range(100)], "k bigint")
    for broadcast in (True, False):
        out = range_lookup(ev, "k", _dict(spark), broadcast=broadcast)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan
        # the shuffled lookup broadcasts only the bounded set of hot buckets
        assert ("SortMergeJoin" in plan) == (not broadcast)


def test_any_bucket_width_and_broadcast_budget(spark):
    ev = spark.createDataFrame([(k,) for k in (0, 5, 25, 30, 31)], "k bigint")
    out = range_lookup(ev, "k", _dict(spark), bucket_bits=5)  # not a preset width
    assert sorted(tuple(r) for r in out.collect())[1] == (5, "p0", "c0")
    st = dictionary_stats(_dict(spark), payload=["province", "city"])
    tight = st.estimated_bytes(12)
    assert st.bucket_bits(max_bytes=tight) >= 12
    assert st.estimated_bytes(st.bucket_bits(max_bytes=tight)) <= tight


def test_salt_ignores_map_columns(spark):
    ev = spark.createDataFrame([(1, {"a": 1}), (25, {"b": 2})], "k bigint, m map<string,int>")
    out = range_lookup(ev, "k", _dict(spark), broadcast=False)
    assert sorted(r["province"] for r in out.collect()) == ["p0", "p1"]


def _dense_dictionary():
    # 2000 single-address ranges (every other key) inside one small block,
    # surrounded by two wide ranges: the block's buckets are dense.
    rows = [(0, 999_999, "wide", "low")]
    rows += [(1_000_000 + 2 * i, 1_000_000 + 2 * i, "dense", f"c{i}") for i in range(2000)]
    rows += [(2_000_000, 2_000_000 + (1 << 24), "wide", "high")]
    return rows


def test_dense_dictionary_is_refined_and_exact(spark):
    import bisect

    from adtally.operators.range_join import dictionary_stats as stats_of

    ranges = _dense_dictionary()
    d = _dict(spark, ranges)
    st = stats_of(d, payload=["province", "city"])
    bits = st.bucket_bits(256 << 20)
    assert refinement_levels(d, "ip_start", "ip_end", bits, 32, st)  # dense buckets need finer levels
    rnd = random.Random(3)
    keys = [rnd.randrange(990_000, 1_010_000) for _ in range(3000)] + [rnd.randrange(0, 1 << 25) for _ in range(500)]
    starts = [r[0] for r in ranges]

    def brute(k):
        i = bisect.bisect_right(starts, k) - 1
        return ranges[i][3] if i >= 0 and ranges[i][0] <= k <= ranges[i][1] else None

    ev = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id bigint, k bigint")
    for broadcast in (True, False):
        got = {r["id"]: r["city"] for r in range_lookup(ev, "k", d, broadcast=broadcast).collect()}
        assert len(got) == len(keys)
        assert all(got[i] == brute(k) for i, k in enumerate(keys)), broadcast


def test_refined_buckets_hold_at_most_the_limit(spark):
    from adtally.operators.range_join import _B, _LV, _refine, explode_ranges

    d = _dict(spark, _dense_dictionary())
    st = dictionary_stats(d, payload=["province", "city"])
    bits = st.bucket_bits(256 << 20)
    levels = refinement_levels(d, "ip_start", "ip_end", bits, 32, st)
    dim = explode_ranges(d, "ip_start", "ip_end", ["province", "city"], bits).withColumn(_LV, F.lit(0))
    probe = spark.createDataFrame([(1,)], "_rl_key bigint").withColumn(_B, F.lit(0).cast("bigint")).withColumn(_LV, F.lit(0))
    refined, _ = _refine(dim, probe, bits, levels, 32)
    worst = refined.groupBy(_LV, _B).count().agg(F.max("count")).first()[0]
    unrefined = dim.groupBy(_B).count().agg(F.max("count")).first()[0]
    assert unrefined > 32 >= worst


def test_precomputed_stats_are_reused(spark):
    d = _dict(spark)
    st = dictionary_stats(d, payload=["province", "city"])
    ev = spark.createDataFrame([(k,) for k in (5, 25, 50)], "k bigint")
    out = range_lookup(ev, "k", d, stats=st)
    assert sorted((r["k"], r["province"]) for r in out.collect()) == [(5, "p0"), (25, "p1"), (50, None)]


def _narrowest(keys, ranges):
    out = []
    for k in keys:
        hits = [(e - s, p, c) for s, e, p, c in ranges if s <= k <= e]
        out.append((k, *(min(hits)[1:] if hits else (None, None))))
    return sorted(out)


def _nest(rnd, lo, hi, depth, out):
    """Random ranges nested in lo..hi."""
    at = lo
    while at <= hi and len(out) < 400:
        width = rnd.choice([1, 2, 3, 17, 256, 70_000, 1 << 21, 1 << 26])
        s = at + rnd.choice([0, 0, 1, 1000])
        e = min(s + width - 1, hi)
        if s > hi or (s, e) == (lo, hi):
            return
        out.append((s, e, f"p{len(out)}", f"c{depth}"))
        if depth < 4 and e > s:
            _nest(rnd, s, e, depth + 1, out)
        at = e + 1 + rnd.choice([0, 0, 5, 1 << 22])


@pytest.mark.parametrize("broadcast", [True, False])
def test_nested_ranges_give_the_narrowest(spark, broadcast):
    import duckdb

    rnd = random.Random(11)
    ranges = [(0, (1 << 32) - 1, "world", "w"), ((1 << 32) - 1, (1 << 32) - 1, "last", "l")]
    _nest(rnd, 5, 1 << 31, 0, ranges)
    assert len(ranges) > 300
    edges = [x for s, e, *_ in ranges for x in (s - 1, s, e, e + 1) if 0 <= x < 1 << 32]
    keys = edges + [rnd.randrange(1 << 32) for _ in range(2000)]
    out = range_lookup(spark.createDataFrame([(k,) for k in keys], "k bigint"), "k", _dict(spark, ranges), nested=True, broadcast=broadcast, bucket_bits=None if broadcast else 20)
    got = sorted(tuple(r) for r in out.collect())
    assert got == _narrowest(keys, ranges)
    con = duckdb.connect()
    con.execute("CREATE TABLE d (s BIGINT, e BIGINT, p VARCHAR, c VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?, ?)", ranges)
    con.execute("CREATE TABLE k (i BIGINT, k BIGINT)")
    con.executemany("INSERT INTO k VALUES (?, ?)", list(enumerate(keys)))
    assert got == sorted(con.execute("SELECT k, arg_min(p, e - s), arg_min(c, e - s) FROM k LEFT JOIN d ON k BETWEEN s AND e GROUP BY i, k").fetchall())


def test_disjoint_ranges_stay_what_they_are(spark):
    from adtally.operators import disjoint_ranges

    cut = sorted(tuple(r) for r in disjoint_ranges(_dict(spark)).collect())
    assert cut == sorted(RANGES)
    assert disjoint_ranges(_dict(spark, [])).collect() == []


@pytest.mark.parametrize("bad", [
    [(0, 10, "a", "b"), (5, 15, "c", "d")],
    [(0, 100, "a", "b"), (10, 50, "c", "d"), (40, 60, "e", "f")],
    [(0, 10, "a", "b"), (0, 10, "c", "d")],
    [(10, 0, "a", "b")],
    [(None, 0, "a", "b")],
])
def test_overlap_without_nesting_still_raises(spark, bad):
    ev = spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(OverlappingRangesError):
        range_lookup(ev, "k", _dict(spark, bad), nested=True)


def test_hot_keys_are_salted_without_a_count(spark):
    rows = [(i, 25 if i % 3 == 0 else i % 20) for i in range(3000)]
    ev = spark.createDataFrame(rows, "id bigint, k bigint")
    out = range_lookup(ev, "k", _dict(spark), broadcast=False, hot_keys=[25])
    want = range_lookup(ev, "k", _dict(spark), broadcast=True)
    assert sorted(map(tuple, out.select("id", "k", "city").collect())) == sorted(map(tuple, want.select("id", "k", "city").collect()))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # none with counted buckets
    with pytest.raises(ValueError):
        range_lookup(ev, "k", _dict(spark), broadcast=False, hot_keys=range(5000))


def test_levels_cost_no_shuffle_of_the_log(spark):
    # 300 single addresses in one corner of a dictionary of wide ranges
    wide = [(i << 22, (i << 22) + (1 << 21) - 1, "w", f"w{i}") for i in range(1, 400)]
    dense = [(i * 2, i * 2, "d", f"d{i}") for i in range(300)]
    keys = [(k,) for k in [*range(0, 700), *[(i << 22) + 5 for i in range(400)]]]
    ev = spark.createDataFrame(keys, "k bigint")
    out = range_lookup(ev, "k", _dict(spark, wide + dense), broadcast=False, max_broadcast_bytes=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    levels = plan.count("_rl_bits")
    assert levels and plan.count("SortMergeJoin") == 1
    assert plan.count("Exchange hashpartitioning") == 2  # both sides of the final join
    assert sorted(tuple(r) for r in out.collect()) == _brute([k for k, in keys], wide + dense)
    with pytest.raises(ValueError):
        range_lookup(ev, "k", _dict(spark), dense_ranges=1)
