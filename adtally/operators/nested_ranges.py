"""Nested ranges cut into disjoint ones, of which the narrowest wins.

Address registries nest: a carrier's block holds a city's, which holds a
customer's. A key belongs to the narrowest range that holds it. The ranges' ends
cut the key space into stretches; a stretch belongs to the narrowest range over
its first key. Which ranges those are is an equi-join: each range is written as
at most 62 blocks (a power of two of keys that starts at a multiple of its size),
and a key is in a block if it has its prefix, so a stretch meets as many rows as
ranges nest over it, however wide they are.

A wide block is met by many stretches: blocks of ``WIDE_BITS`` and more are few
and broadcast if their counted rows are, else joined with Spark's skew handling.
The stretches' ends come from windows over buckets of 2^20 keys, which hold at
most as many stretches; so a range is also cut where a bucket starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.errors import OverlappingRangesError
from adtally.session import shared_dir

# IPv4 keys live in [0, 2^32).
KEY_DOMAIN_BITS = 32
#: Keys of a bucket of the window that finds the stretches' ends, as a power of two.
WINDOW_BITS = 20
#: Blocks of at least this width, as a power of two, are joined apart.
WIDE_BITS = 16
BROADCAST_BLOCKS = 300_000


def _blocks() -> str:
    """SQL of the blocks (width as a power of two, prefix) that make up _lo.._hi."""
    fit = "length(bin(_hi - acc.at + 1)) - 1"  # no wider than what is left
    aligned = f"if(acc.at = 0, {KEY_DOMAIN_BITS}, length(bin(acc.at & -acc.at)) - 1)"
    width = f"least({aligned}, {fit})"
    block = f"named_struct('width', {width}, 'prefix', shiftright(acc.at, {width}))"
    return f"""aggregate(sequence(1, {2 * KEY_DOMAIN_BITS}),
      named_struct('at', _lo, 'out', cast(array() AS array<struct<width: int, prefix: bigint>>)),
      (acc, i) -> if(acc.at > _hi, acc, named_struct('at', acc.at + shiftleft(1L, {width}), 'out', concat(acc.out, array({block})))),
      acc -> acc.out)"""


def disjoint_ranges(ranges: DataFrame, start: str = "ip_start", end: str = "ip_end") -> DataFrame:
    """Disjoint ranges, with all other columns of ``ranges``, in which every key has
    the row of the narrowest range that holds it. Ranges that overlap without
    nesting, two ranges with the same ends, and malformed ones are an error."""
    shared_dir(ranges.sparkSession)
    payload = [c for c in ranges.columns if c not in (start, end)]
    rows = ranges.select(F.col(start).cast("bigint").alias("_lo"), F.col(end).cast("bigint").alias("_hi"), F.struct(*payload).alias("_row")).checkpoint(eager=True)
    sound = F.col("_lo").isNotNull() & F.col("_hi").isNotNull() & (F.col("_lo") <= F.col("_hi")) & (F.col("_lo") >= 0) & (F.col("_hi") < 1 << KEY_DOMAIN_BITS)
    malformed = rows.where(~F.coalesce(sound, F.lit(False))).count()
    if malformed:
        raise OverlappingRangesError(f"range dictionary has {malformed} malformed range(s)")
    twice = rows.groupBy("_lo", "_hi").count().where("count > 1").count()
    if twice:
        raise OverlappingRangesError(f"range dictionary has {twice} range(s) that come more than once")

    bucket = F.shiftright("_at", WINDOW_BITS)
    cuts = rows.select(F.explode(F.array("_lo", F.col("_hi") + 1)).alias("_at")).where(F.col("_at") < 1 << KEY_DOMAIN_BITS)
    starts = ranges.sparkSession.range(1 << (KEY_DOMAIN_BITS - WINDOW_BITS)).select(F.shiftleft("id", WINDOW_BITS).alias("_at"))
    following = F.lead("_at").over(Window.partitionBy(bucket).orderBy("_at"))
    stretches = cuts.union(starts).distinct().withColumn("_next", F.coalesce(following, F.shiftleft(bucket + 1, WINDOW_BITS)))

    blocks = rows.select("_lo", "_hi", "_row", F.explode(F.expr(_blocks())).alias("b")).select("_lo", "_hi", "_row", "b.*").checkpoint(eager=True)
    wide = blocks.where(F.col("width") >= WIDE_BITS)
    small = wide.count() <= BROADCAST_BLOCKS
    widths = sorted(r[0] for r in blocks.select("width").distinct().collect())  # at most 33
    found = None
    for some, right in ((lambda w: w >= WIDE_BITS, F.broadcast(wide) if small else wide), (lambda w: w < WIDE_BITS, blocks.where(F.col("width") < WIDE_BITS))):
        used = [w for w in widths if some(w)]
        if used:
            probes = stretches.withColumn("width", F.explode(F.array(*[F.lit(w) for w in used]))).withColumn("prefix", F.expr("shiftright(_at, width)"))
            met = probes.join(right, ["width", "prefix"]).select("_at", "_next", "_lo", "_hi", "_row")
            found = met if found is None else found.union(met)
    if found is None:
        return ranges
    # A range that starts here crosses one that began before and ends first.
    starting = F.max(F.when(F.col("_lo") == F.col("_at"), F.col("_hi")))
    open_end = F.min(F.when(F.col("_lo") < F.col("_at"), F.col("_hi")))
    pieces = found.groupBy("_at", "_next").agg(F.min_by("_row", F.col("_hi") - F.col("_lo")).alias("_row"), F.coalesce(open_end < starting, F.lit(False)).alias("_crossed")).checkpoint(eager=True)
    crossed = pieces.where("_crossed").count()
    if crossed:
        raise OverlappingRangesError(f"range dictionary has {crossed} range(s) that overlap another without nesting in it")
    made = {start: F.col("_at"), end: F.col("_next") - 1}
    return pieces.select(*[made.get(c, F.col(f"_row.`{c}`")).alias(c) for c in ranges.columns])
