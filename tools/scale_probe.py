"""Scale probe: the region KPI pipeline on inputs Spark derives from
``events`` at N times its size, with and without a hot IP.

Usage: python tools/scale_probe.py [sf_dir] [N ...]
       python tools/scale_probe.py [sf_dir] etl [N ...]

Each event is replicated N times with new ids (so every fixture column is
re-derived per copy); the "hot" variant gives one IP to a third of all rows.
Reports wall time per strategy and checks that all strategies agree.
"""

from __future__ import annotations

import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, ".")
from adtally import fixtures as fx  # noqa: E402
from adtally.operators import enrich_ips, kpi_report  # noqa: E402


def scaled_events(spark, sf_dir, n):
    ev = fx.load(spark, sf_dir, "events")
    step = ev.agg(F.max("event_id")).first()[0] + 1
    parts = max(spark.sparkContext.defaultParallelism, n)
    return (
        ev.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .repartition(parts)
        .withColumn("event_id", F.col("event_id") + F.col("_k") * step)
        .drop("_k")
    )


def run(label, df):
    t = time.perf_counter()
    rows = sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())
    print(f"  {label}: {time.perf_counter() - t:.2f}s, {len(rows)} groups", flush=True)
    return rows


def etl_probe(spark, sf_dir, n):
    """JSON log -> run_etl -> run_reports for one day, timed."""
    from adtally.plans import run_etl, run_reports
    from adtally.schema import DATED_LOG_SCHEMA
    from adtally.session import scratch_path

    log_dir, out = scratch_path(spark, "probe-log"), scratch_path(spark, "probe-etl")
    fx.ad_log(scaled_events(spark, sf_dir, n)).drop("ip_num").write.json(log_dir)
    t = time.perf_counter()
    run_etl(spark, log_dir, fx.ip_dict_from(spark, sf_dir), out, log_schema=DATED_LOG_SCHEMA, stamp=False)
    t1 = time.perf_counter()
    reports = run_reports(spark, out, fx.DAY)
    sizes = {k: v.count() for k, v in reports.items()}
    t2 = time.perf_counter()
    print(f"x{n} ETL (JSON -> enriched parquet): {t1 - t:.2f}s; all reports of {fx.DAY}: {t2 - t1:.2f}s {sizes}")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    if len(sys.argv) > 2 and sys.argv[2] == "etl":
        spark = (SparkSession.builder.master("local[8]").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="adtally-"))
                 .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
                 .config("spark.sql.shuffle.partitions", "16").config("spark.driver.memory", "8g")
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        for n in [int(x) for x in sys.argv[3:]] or [10]:
            etl_probe(spark, sf_dir, n)
        spark.stop()
        return
    sizes = [int(x) for x in sys.argv[2:]] or [10]
    spark = (SparkSession.builder.master("local[8]").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="adtally-"))
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16").config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    d = fx.ip_dict_from(spark, sf_dir)
    for n in sizes:
        log = fx.ad_log(scaled_events(spark, sf_dir, n))
        rows = log.count()
        print(f"x{n}: {rows} events")
        a = run("broadcast lookup", kpi_report(enrich_ips(log, d, broadcast=True), report_date="2024-01-30"))
        b = run("salted shuffle lookup", kpi_report(enrich_ips(log, d, broadcast=False), report_date="2024-01-30"))
        assert a == b
        third = F.pmod(F.xxhash64("uuid"), F.lit(3)) == 0
        hot = log.withColumn("ip", F.when(third, F.lit("10.0.0.1")).otherwise(F.col("ip")))
        h1 = run("hot IP, broadcast", kpi_report(enrich_ips(hot, d, broadcast=True), report_date="2024-01-30"))
        h2 = run("hot IP, salted shuffle", kpi_report(enrich_ips(hot, d, broadcast=False), report_date="2024-01-30"))
        assert h1 == h2
    spark.stop()


if __name__ == "__main__":
    main()
