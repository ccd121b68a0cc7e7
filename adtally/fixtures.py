"""Test inputs derived from the driver's tables (see FIXTURES.md).

The reference ships neither its ad log nor its IP dictionary, so both are
derived from ``events`` and ``nation`` x ``region`` with integer formulas that
give identical rows in Spark and in DuckDB. Spark builds them with DataFrame
expressions (so their size grows with ``events``); ``AD_LOG_SQL`` /
``IP_DICT_SQL`` are the same definitions as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.ip import long_to_ip_sql

# Fixed values of the fixture formulas: H(a, b) = ((event_id + 1) * a) % b.
IP_HASH = (2654435761, 4294967291)
REQUESTMODE_HASH = (48271, 65537)
PROCESSNODE_HASH = (69621, 99991)
PROVIDER_HASH = (16807, 64007)
ISEFFECTIVE_HASH = (39373, 77773)
ISBILLING_HASH = (40692, 88811)
ISBID_HASH = (40014, 70001)
ISWIN_HASH = (53668, 90001)
ADORDER_HASH = (52774, 60013)
ADCREATIVE_HASH = (12211, 50021)
DEVICE_HASH = (22543, 70111)
NETWORK_HASH = (31337, 65003)
ISP_HASH = (45007, 80021)
NULL_IP_MOD = 97
BAD_IP_MOD = 101
NULL_ISBID_MOD = 89
NULL_WINPRICE_MOD = 83
PROVIDER_BASE = 99990
PROVIDER_SPREAD = 40
ADORDER_VALUES = (0, 150000, 200000, 200001, 250000)
ADCREATIVE_VALUES = (200000, 200001, 250000)
WINPRICE_FACTOR = 100
ADPAYMENT_FACTOR = 130
CHANNELS = 7
DICT_RANGES_PER_NATION = 4
DICT_STRIDE = 42949672
DICT_WIDTH = 37999999
BAD_IP_TEXT = "bad-ip"

# Fixed report dates used by the registered queries.
DAY = "2024-01-15"
FIRST_DAY = "2024-01-01"
PREVIOUS_DAY = "2024-01-14"
ALL_DAYS_REPORT_DATE = "2024-01-30"
ETL_RUN_DATE = "2024-01-31"


def _h(pair: tuple[int, int]) -> str:
    """SQL text of ((event_id + 1) * a) % b, exact in bigint for every event_id.

    (x * a) % b == ((x % b) * (a % b)) % b. When b * b could overflow, ``a`` is
    taken 16 bits at a time (Horner): r = (r * 2^16 + x * limb) % b, where
    every intermediate stays below b * 2^16 < 2^63 for b < 2^47.
    """
    a, b = pair
    x = f"((event_id + 1) % {b})"
    a %= b
    if b * b < (1 << 63):
        return f"(({x} * {a}) % {b})"
    assert b < (1 << 47)
    limbs = []
    while a:
        limbs.append(a & 0xFFFF)
        a >>= 16
    r = "CAST(0 AS BIGINT)"
    for limb in reversed(limbs):
        r = f"(({r} * 65536 + {x} * {limb}) % {b})"
    return r


def _pick(index_sql: str, values: tuple[int, ...]) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {index_sql} {whens} END"


def ad_log(events: DataFrame) -> DataFrame:
    """One ad-event row per ``events`` row (FIXTURES.md section 1).

    Built from SQL expressions (one JVM call per column). The IP hash is
    computed in its own projection so it is evaluated once per row rather
    than inlined into each of its uses.
    """
    events = events.select("event_id", "ts", "user_id", "event_type", "value")
    hashed = events.selectExpr("*", f"{_h(IP_HASH)} AS _ip_hash")
    hidden = f"event_id % {NULL_IP_MOD} = 0 OR event_id % {BAD_IP_MOD} = 0"
    return hashed.selectExpr(
        "concat('u', CAST(event_id AS STRING)) AS uuid",
        "CAST(CAST(ts AS DATE) AS STRING) AS date_str",
        f"CASE WHEN {hidden} THEN NULL ELSE _ip_hash END AS ip_num",
        f"CASE WHEN event_id % {NULL_IP_MOD} = 0 THEN CAST(NULL AS STRING) "
        f"WHEN event_id % {BAD_IP_MOD} = 0 THEN '{BAD_IP_TEXT}' "
        f"ELSE {long_to_ip_sql('_ip_hash')} END AS ip",
        f"1 + {_h(REQUESTMODE_HASH)} % 3 AS requestmode",
        f"1 + {_h(PROCESSNODE_HASH)} % 3 AS processnode",
        f"{PROVIDER_BASE} + {_h(PROVIDER_HASH)} % {PROVIDER_SPREAD} AS adplatformproviderid",
        f"CASE WHEN {_h(ISEFFECTIVE_HASH)} % 8 = 0 THEN 0 ELSE 1 END AS iseffective",
        f"CASE WHEN {_h(ISBILLING_HASH)} % 8 = 0 THEN 0 ELSE 1 END AS isbilling",
        f"CASE WHEN event_id % {NULL_ISBID_MOD} = 0 THEN CAST(NULL AS INT) "
        f"WHEN {_h(ISBID_HASH)} % 6 = 0 THEN 0 ELSE 1 END AS isbid",
        f"CASE WHEN {_h(ISWIN_HASH)} % 6 = 0 THEN 0 ELSE 1 END AS iswin",
        f"CAST({_pick(f'{_h(ADORDER_HASH)} % {len(ADORDER_VALUES)}', ADORDER_VALUES)} AS BIGINT) AS adorderid",
        f"CAST({_pick(f'{_h(ADCREATIVE_HASH)} % {len(ADCREATIVE_VALUES)}', ADCREATIVE_VALUES)} AS BIGINT) AS adcreativeid",
        f"CASE WHEN event_id % {NULL_WINPRICE_MOD} = 0 THEN CAST(NULL AS DOUBLE) "
        f"ELSE value * {WINPRICE_FACTOR} END AS winprice",
        f"value * {ADPAYMENT_FACTOR} AS adpayment",
        "event_type AS appname",
        f"concat('d', CAST({_h(DEVICE_HASH)} % 4 AS STRING)) AS device",
        f"{_h(NETWORK_HASH)} % 5 AS network",
        f"{_h(ISP_HASH)} % 4 AS isp",
        f"user_id % {CHANNELS} AS channelid",
    )


def ip_dict(nation: DataFrame, region: DataFrame) -> DataFrame:
    """100 non-overlapping IP ranges, each followed by a gap (FIXTURES.md 2).

    ``nation`` and ``region`` are small dimensions; the join strategy is left
    to Spark's size-based planning (no unmeasured broadcast hint).
    """
    start = f"(CAST(n_nationkey AS BIGINT) * {DICT_RANGES_PER_NATION} + k) * {DICT_STRIDE}"
    return (
        nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
        .selectExpr("n_nationkey", "n_name", "r_name",
                    f"explode(sequence(0, {DICT_RANGES_PER_NATION - 1})) AS k")
        .selectExpr(
            f"{start} AS ip_start",
            f"{start} + {DICT_WIDTH} AS ip_end",
            "r_name AS province",
            "n_name AS city",
        )
    )


def region_strings(ip_dict_df: DataFrame) -> DataFrame:
    """The dictionary as (ip_start, ip_end, region) with five-part strings."""
    return ip_dict_df.select(
        "ip_start",
        "ip_end",
        F.concat(F.lit("X|0|"), "province", F.lit("|"), "city", F.lit("|isp")).alias("region"),
    )


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver's tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ad_log_from(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    """The ad log, or one day of it: the day is a range of ``ts``, which the scan
    can use to skip row groups, not a filter on the derived text."""
    events = load(spark, sf_dir, "events")
    if day is not None:
        start = F.lit(day).cast("timestamp")
        events = events.where((F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 1 DAY")))
    return ad_log(events)


def ip_dict_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ip_dict(load(spark, sf_dir, "nation"), load(spark, sf_dir, "region"))


# ---------------------------------------------------------------------------
# The same fixtures as SQL text (DuckDB dialect, also valid Spark SQL), used by
# the oracle. Written independently of the DataFrame code above.

def _hs(a: int, b: int) -> str:
    return f"(((event_id + 1) * {a}) % {b})"


AD_LOG_SQL = f"""
SELECT
  concat('u', CAST(event_id AS VARCHAR)) AS uuid,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS date_str,
  CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL
       ELSE {_hs(*IP_HASH)} END AS ip_num,
  CASE WHEN event_id % 97 = 0 THEN NULL
       WHEN event_id % 101 = 0 THEN 'bad-ip'
       ELSE concat(
         CAST(CAST(({_hs(*IP_HASH)} - {_hs(*IP_HASH)} % 16777216) / 16777216 AS BIGINT) AS VARCHAR), '.',
         CAST(CAST(({_hs(*IP_HASH)} % 16777216 - {_hs(*IP_HASH)} % 65536) / 65536 AS BIGINT) AS VARCHAR), '.',
         CAST(CAST(({_hs(*IP_HASH)} % 65536 - {_hs(*IP_HASH)} % 256) / 256 AS BIGINT) AS VARCHAR), '.',
         CAST({_hs(*IP_HASH)} % 256 AS VARCHAR))
  END AS ip,
  CAST(1 + {_hs(*REQUESTMODE_HASH)} % 3 AS BIGINT) AS requestmode,
  CAST(1 + {_hs(*PROCESSNODE_HASH)} % 3 AS BIGINT) AS processnode,
  CAST(99990 + {_hs(*PROVIDER_HASH)} % 40 AS BIGINT) AS adplatformproviderid,
  CAST(CASE WHEN {_hs(*ISEFFECTIVE_HASH)} % 8 = 0 THEN 0 ELSE 1 END AS INTEGER) AS iseffective,
  CAST(CASE WHEN {_hs(*ISBILLING_HASH)} % 8 = 0 THEN 0 ELSE 1 END AS INTEGER) AS isbilling,
  CAST(CASE WHEN event_id % 89 = 0 THEN NULL
            WHEN {_hs(*ISBID_HASH)} % 6 = 0 THEN 0 ELSE 1 END AS INTEGER) AS isbid,
  CAST(CASE WHEN {_hs(*ISWIN_HASH)} % 6 = 0 THEN 0 ELSE 1 END AS INTEGER) AS iswin,
  CAST(CASE {_hs(*ADORDER_HASH)} % 5 WHEN 0 THEN 0 WHEN 1 THEN 150000 WHEN 2 THEN 200000
            WHEN 3 THEN 200001 ELSE 250000 END AS BIGINT) AS adorderid,
  CAST(CASE {_hs(*ADCREATIVE_HASH)} % 3 WHEN 0 THEN 200000 WHEN 1 THEN 200001
            ELSE 250000 END AS BIGINT) AS adcreativeid,
  CASE WHEN event_id % 83 = 0 THEN NULL ELSE value * 100 END AS winprice,
  value * 130 AS adpayment,
  event_type AS appname,
  concat('d', CAST({_hs(*DEVICE_HASH)} % 4 AS VARCHAR)) AS device,
  CAST({_hs(*NETWORK_HASH)} % 5 AS BIGINT) AS network,
  CAST({_hs(*ISP_HASH)} % 4 AS BIGINT) AS isp,
  CAST(user_id % 7 AS BIGINT) AS channelid
FROM events
"""

IP_DICT_SQL = """
SELECT
  (CAST(n.n_nationkey AS BIGINT) * 4 + k.k) * 42949672 AS ip_start,
  (CAST(n.n_nationkey AS BIGINT) * 4 + k.k) * 42949672 + 37999999 AS ip_end,
  r.r_name AS province,
  n.n_name AS city
FROM nation n
JOIN region r ON n.n_regionkey = r.r_regionkey
CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) k
"""

ENRICHED_SQL = """
SELECT a.*, d.province, d.city
FROM ad_log a
LEFT JOIN ip_dict d ON a.ip_num BETWEEN d.ip_start AND d.ip_end
"""


def with_fixtures(select_sql: str) -> str:
    """Prefix a query with the fixture CTEs ad_log, ip_dict and enriched."""
    return (
        f"WITH ad_log AS ({AD_LOG_SQL}),\n"
        f"ip_dict AS ({IP_DICT_SQL}),\n"
        f"enriched AS ({ENRICHED_SQL})\n"
        f"{select_sql}"
    )
