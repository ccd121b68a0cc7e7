"""Micro-benchmark of the range lookup on a dense dictionary region.

Usage: python tools/dense_lookup_bench.py [probes]

The dictionary is built by rule: 30,000 ranges 2^17 wide plus a block of
20,000 single-address ranges; the probes all fall in the block. Compares the
automatic refinement against a forced single level (same results).
"""

from __future__ import annotations

import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, ".")
from adtally.operators import dictionary_stats, range_lookup  # noqa: E402
from adtally.operators.range_join import refinement_levels  # noqa: E402

WIDE, N_WIDE, N_DENSE, BLOCK = 1 << 17, 30_000, 20_000, 1_000_000


def main():
    probes = int(sys.argv[1]) if len(sys.argv) > 1 else 5_000_000
    spark = (SparkSession.builder.master("local[8]").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="adtally-"))
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16").config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    d = spark.range(N_DENSE).selectExpr(
        f"{BLOCK} + 2 * id AS ip_start", f"{BLOCK} + 2 * id AS ip_end",
        "'dense' AS province", "concat('c', id) AS city",
    ).unionByName(spark.range(N_WIDE).selectExpr(
        f"{2 * BLOCK} + id * {WIDE} AS ip_start", f"{2 * BLOCK} + (id + 1) * {WIDE} - 1 AS ip_end",
        "'wide' AS province", "concat('w', id) AS city",
    )).cache()
    ev = spark.range(probes).selectExpr("id", f"{BLOCK} + pmod(xxhash64(id), {2 * N_DENSE}) AS k").cache()
    ev.count()
    st = dictionary_stats(d, payload=["province", "city"])
    bits = st.bucket_bits(256 << 20)
    print(f"bucket bits {bits}, refinement levels {refinement_levels(d, 'ip_start', 'ip_end', bits, 32, st)}")
    results = {}
    for label, kw in (("refined", {}), ("single level", {"refine": []})):
        t = time.perf_counter()
        out = range_lookup(ev, "k", d, broadcast=True, **kw)
        results[label] = out.groupBy("province").count().collect()
        print(f"{label}: {time.perf_counter() - t:.1f}s")
    assert sorted(results["refined"]) == sorted(results["single level"])
    spark.stop()


if __name__ == "__main__":
    main()
