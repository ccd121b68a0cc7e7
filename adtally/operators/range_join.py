"""Range lookup: for every row find the dictionary range holding its key.

Spark has no native range join; a plain ``key BETWEEN start AND end`` join is
planned as a nested-loop join. Here each range is exploded into the fixed-width
buckets it touches (bucket = key >> bucket_bits) and the join becomes an
equi-join on the bucket with the range test as a residual condition. The
width is chosen from the dictionary (about its median range width), so a
typical range touches one or two buckets and a probe meets few candidates:

* rows after exploding = sum(width / 2^bits + 1) <= n_ranges + 2^(32 - bits)
  for non-overlapping ranges in [0, 2^32), so the dictionary side is bounded by
  its own size plus a constant, independent of the event volume;
* the event side is never shuffled when the dictionary fits the broadcast
  budget (size is *measured*, not assumed);
* above the budget the join shuffles on (bucket, salt): the buckets that hold
  more than one task's share of the events are measured, and only those are
  salted, with as many salts as they hold shares (the dictionary's rows of the
  bucket are replicated once per salt); rows with a NULL key match nothing and
  are spread over buckets that no range has;

* a bucket touched by more than ``dense_ranges`` ranges (a dense region of
  narrow ranges, measured at the width in use) is re-exploded 2^6 times finer,
  level by level, once, and checkpointed; a probe finds its level in a map of one
  bit per bucket, of at most 2^32 / dense_ranges bits a level whatever the
  dictionary, which is broadcast: the log is never shuffled for it. So no probe
  meets more than ``dense_ranges`` candidates and no candidate is ever dropped.

Ranges must not overlap (a key would match twice and duplicate its row), unless
``nested=True``: then nested ranges are cut into disjoint ones first
(:mod:`adtally.operators.nested_ranges`). The check runs as one distributed job over the dictionary, which also measures
its size and the per-bucket density that decide the plan.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from adtally.errors import OverlappingRangesError
from adtally.operators.nested_ranges import disjoint_ranges
from adtally.session import shared_dir

# IPv4 keys live in [0, 2^32).
KEY_DOMAIN_BITS = 32
# Candidate bucket widths 2^bits; the lookup picks one from the dictionary.
BUCKET_BITS_CHOICES = (8, 10, 12, 14, 16, 18, 20, 22, 24)
# Buckets of the validation pass (independent of the lookup's width):
# at most n_ranges + 2^12 exploded rows.
CHECK_BUCKET_BITS = 20
# A bucket touched by more ranges than this is re-exploded 2^REFINE_BITS
# times finer (recursively), so a probe never meets more candidates.
DEFAULT_DENSE_RANGES = 32
REFINE_BITS = 6
# Below this the map of refined buckets (2^32 / dense_ranges bits) would be no
# size to broadcast.
MIN_DENSE_RANGES = 4
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# Keys that a caller may name as hot (they are written into the plan).
MAX_HOT_KEYS = 1000
# Estimated bytes per exploded dictionary row besides its strings
# (three longs, two string headers, row overhead).
_ROW_OVERHEAD_BYTES = 64

log = logging.getLogger(__name__)

_B, _S, _LO, _HI, _LV = "_rl_bucket", "_rl_salt", "_rl_start", "_rl_end", "_rl_level"


@dataclass(frozen=True)
class DictionaryStats:
    ranges: int
    malformed: int
    overlaps: int
    wide_ranges: dict  # bucket bits -> ranges at least 2^bits wide
    payload_bytes: int
    exploded_rows: dict  # bucket bits -> rows after exploding at that width
    # bucket bits -> most ranges touching one bucket, where measured
    density: dict = field(default_factory=dict)

    def bucket_bits(self, max_bytes: int | None = None) -> int:
        """Bucket width ~ the median range width: a typical range touches one
        or two buckets and a bucket holds a few ranges, so both the exploded
        dictionary and the candidates per probe stay small.

        With ``max_bytes``, widen the buckets until the exploded dictionary
        fits that budget (a dictionary covering the whole key space with tiny
        ranges explodes to ~2^(32-bits) rows at a narrow width).
        """
        choices = sorted(self.exploded_rows)
        best = choices[0]
        for bits in choices:
            # 2^bits <= median width  <=>  at least half the ranges are that wide
            if 2 * self.wide_ranges[bits] >= self.ranges:
                best = bits
        if max_bytes is not None:
            for bits in choices:
                if bits >= best and self.estimated_bytes(bits) <= max_bytes:
                    return bits
        return best

    def estimated_bytes(self, bits: int) -> int:
        rows = self.exploded_rows[bits]
        per_row = _ROW_OVERHEAD_BYTES + (self.payload_bytes // max(self.ranges, 1))
        return rows * per_row


def explode_ranges(
    ranges: DataFrame, start: str, end: str, payload: list[str], bucket_bits: int
) -> DataFrame:
    """One row per (range, bucket it touches), with internal column names."""
    return ranges.select(
        F.col(start).cast("bigint").alias(_LO),
        F.col(end).cast("bigint").alias(_HI),
        *[F.col(c) for c in payload],
    ).withColumn(
        _B,
        F.explode(F.sequence(F.shiftright(_LO, bucket_bits), F.shiftright(_HI, bucket_bits))),
    )


def dictionary_stats(
    ranges: DataFrame,
    start: str = "ip_start",
    end: str = "ip_end",
    payload: list[str] | None = None,
    widths: tuple[int, ...] = BUCKET_BITS_CHOICES,
) -> DictionaryStats:
    """ONE distributed job over the dictionary: validity, widths, size.

    Overlap test: two ranges overlap only if they share a bucket, so ordering
    each bucket's ranges by start and comparing with the previous end finds
    every overlap. Malformed ranges (NULL bound, start > end, outside
    [0, 2^32)) are counted in the same pass. The exploded size for every
    candidate width is a sum over ranges, so no second pass is needed.
    """
    payload = list(payload or [])
    lo, hi = f"CAST(`{start}` AS BIGINT)", f"CAST(`{end}` AS BIGINT)"
    nbytes = " + ".join([f"coalesce(octet_length(`{c}`), 0)" for c in payload] or ["0"])
    ok = f"{_LO} IS NOT NULL AND {_HI} IS NOT NULL AND {_LO} <= {_HI} AND {_LO} >= 0 AND {_HI} < {1 << KEY_DOMAIN_BITS}"
    cb = CHECK_BUCKET_BITS
    # The first bucket of each valid range stands for the range itself.
    first = f"(_ok AND {_B} = shiftright({_LO}, {cb}))"
    per_bits = [
        f"sum(CASE WHEN {first} THEN shiftright({_HI}, {b}) - shiftright({_LO}, {b}) + 1 ELSE 0 END) AS rows_{b}"
        for b in widths
    ]
    row = (
        ranges.selectExpr(f"{lo} AS {_LO}", f"{hi} AS {_HI}", f"{nbytes} AS _bytes")
        .selectExpr("*", f"{ok} AS _ok")
        .selectExpr(
            "*",
            # Malformed rows get negative buckets spread by a hash, so even a
            # dictionary of mostly bad rows never lands in one window task.
            f"explode(CASE WHEN _ok THEN sequence(shiftright({_LO}, {cb}), shiftright({_HI}, {cb})) "
            f"ELSE array(-1 - pmod(xxhash64({_LO}, {_HI}, _bytes), 4096)) END) AS {_B}",
        )
        .selectExpr(
            "*",
            f"CASE WHEN _ok THEN lag({_HI}) OVER (PARTITION BY {_B} ORDER BY {_LO}, {_HI}) END AS _prev_end",
        )
        .selectExpr(
            f"count_if({first}) AS ranges",
            "count_if(NOT _ok) AS malformed",
            f"count_if(_prev_end >= {_LO}) AS overlaps",
            *[
                f"count_if({first} AND {_HI} - {_LO} + 1 >= {1 << b}) AS wide_{b}"
                for b in widths
            ],
            f"sum(CASE WHEN {first} THEN _bytes ELSE 0 END) AS bytes",
            *per_bits,
        )
        .first()
    )
    stats = DictionaryStats(
        ranges=int(row["ranges"] or 0),
        malformed=int(row["malformed"] or 0),
        overlaps=int(row["overlaps"] or 0),
        wide_ranges={b: int(row[f"wide_{b}"] or 0) for b in widths},
        payload_bytes=int(row["bytes"] or 0),
        exploded_rows={b: int(row[f"rows_{b}"] or 0) for b in widths},
    )
    if not stats.overlaps and not stats.malformed:
        bits = stats.bucket_bits()
        stats.density[bits] = max_touching(ranges, start, end, bits)
    return stats


def max_touching(ranges: DataFrame, start: str, end: str, bits: int) -> int:
    """Most ranges that touch one 2^bits-wide bucket (one aggregation)."""
    counts = explode_ranges(ranges, start, end, [], bits).groupBy(_B).agg(F.count(F.lit(1)).alias("_n"))
    return int(counts.agg(F.max("_n")).first()[0] or 0)


def refinement_levels(ranges: DataFrame, start: str, end: str, bits: int, dense: int, stats: DictionaryStats | None) -> list[int]:
    """Widths of the finer levels needed so that no probe meets more than
    ``dense`` candidates, each 2^REFINE_BITS times finer, by measuring each."""
    known = stats.density if stats is not None else {}
    if bits not in known:
        known[bits] = max_touching(ranges, start, end, bits)
    levels: list[int] = []
    worst, dim = known[bits], None
    while bits and worst > dense:
        fine = max(0, bits - REFINE_BITS)
        # only what lies in buckets that are too dense is cut finer
        dim = _finer(explode_ranges(ranges, start, end, [], bits) if dim is None else dim, bits, fine, dense)
        worst = int(dim.groupBy(_B).count().agg(F.max("count")).first()[0] or 0)
        levels.append(fine)
        bits = fine
    return levels


def _dense_buckets(dim: DataFrame, dense: int) -> DataFrame:
    return dim.groupBy(_B).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > dense).select(_B)


def _finer(dim: DataFrame, coarse: int, fine: int, dense: int, hot: DataFrame | None = None) -> DataFrame:
    """The ranges of the buckets that more than ``dense`` ranges touch, exploded
    into finer buckets within them."""
    hot = _dense_buckets(dim, dense) if hot is None else hot
    lo = F.greatest(F.col(_LO), F.shiftleft(F.col(_B), coarse))
    hi = F.least(F.col(_HI), F.shiftleft(F.col(_B) + 1, coarse) - 1)
    return dim.join(hot, _B, "left_semi").withColumn(_B, F.explode(F.sequence(F.shiftright(lo, fine), F.shiftright(hi, fine))))


def range_lookup(
    events: DataFrame,
    key,
    ranges: DataFrame,
    start: str = "ip_start",
    end: str = "ip_end",
    payload: tuple[str, ...] = ("province", "city"),
    bucket_bits: int | None = None,
    broadcast: bool | None = None,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    validate: bool = True,
    dense_ranges: int = DEFAULT_DENSE_RANGES,
    refine: list[int] | None = None,
    stats: DictionaryStats | None = None,
    hot_keys: Sequence[int] | None = None,
    nested: bool = False,
) -> DataFrame:
    """Left range join: every event row once, plus ``payload`` of its range
    (NULL when the key is NULL or falls in no range).

    ``key`` is a column name or Column giving a bigint in [0, 2^32).
    ``bucket_bits=None`` derives the bucket width from the dictionary's
    median range width. ``broadcast=None`` broadcasts the exploded dictionary
    only if its measured size fits ``max_broadcast_bytes``; True/False force
    the strategy. Buckets that more than ``dense_ranges`` ranges touch are
    refined to finer widths (``refine``; by default measured), so no probe meets more candidates than that,
    whatever the dictionary's density; no candidate is ever dropped. With
    ``validate=False`` and width, strategy and ``refine`` fixed, no job runs
    here. ``stats`` reuses a :func:`dictionary_stats` result (computed with the
    same ``start``/``end``/``payload``), so several lookups against one
    dictionary validate it once.

    ``hot_keys`` names the keys with very many rows, if they are known (from the
    report of the day before, say): then only their rows are salted and nothing is
    counted first, neither in a batch nor in a stream. ``nested=True`` lets
    ranges nest; a key gets the narrowest range that holds it.
    """
    payload = list(payload)
    if nested:
        ranges, stats = disjoint_ranges(ranges.select(start, end, *payload), start, end), None
    clash = set(payload) & set(events.columns)
    if clash:
        raise ValueError(f"events already have columns {sorted(clash)}")
    if bucket_bits is not None and not 0 < bucket_bits < KEY_DOMAIN_BITS:
        raise ValueError("bucket_bits must be in (0, 32)")
    if dense_ranges < MIN_DENSE_RANGES:
        raise ValueError(f"dense_ranges must be at least {MIN_DENSE_RANGES}")

    if stats is not None and bucket_bits is not None and bucket_bits not in stats.exploded_rows:
        stats = None  # computed for other widths: measure again
    if stats is not None or validate or broadcast is None or bucket_bits is None or refine is None:
        if stats is None:
            widths = tuple(sorted(set(BUCKET_BITS_CHOICES) | ({bucket_bits} if bucket_bits else set())))
            stats = dictionary_stats(ranges, start, end, payload, widths)
        if stats.overlaps or stats.malformed:
            raise OverlappingRangesError(
                f"range dictionary has {stats.overlaps} overlapping pair(s) and "
                f"{stats.malformed} malformed range(s)"
            )
        if bucket_bits is None:
            bucket_bits = stats.bucket_bits(None if broadcast is False else max_broadcast_bytes)
        if refine is None:
            refine = refinement_levels(ranges, start, end, bucket_bits, dense_ranges, stats)
        if broadcast is None:
            # Each refined bucket adds at most 2^REFINE_BITS rows per level
            # beyond the ranges it holds, and there are at most rows/dense
            # such buckets per level.
            growth = 1 + len(refine) * (1 << REFINE_BITS) / max(dense_ranges, 1)
            broadcast = stats.estimated_bytes(bucket_bits) * growth <= max_broadcast_bytes
    refine = list(refine or [])
    if stats is not None:
        log.info(
            "range lookup: %d ranges, buckets of 2^%d, %s, refinement levels %s, "
            "~%d bytes exploded",
            stats.ranges, bucket_bits, "broadcast" if broadcast else "salted shuffle",
            refine, stats.estimated_bytes(bucket_bits) if bucket_bits in stats.exploded_rows else -1,
        )

    key_col = F.col(key) if isinstance(key, str) else key
    cols = events.columns
    dim = explode_ranges(ranges, start, end, payload, bucket_bits).withColumn(_LV, F.lit(0))
    probe = (
        events.withColumn("_rl_key", key_col.cast("bigint"))
        .withColumn(_B, F.shiftright("_rl_key", bucket_bits))
        .withColumn(_LV, F.lit(0))
    )
    if refine:
        dim, probe = _refine(dim, probe, bucket_bits, refine, dense_ranges)

    on_cols = [_LV, _B]
    if not broadcast:
        probe, dim = _salted(events, probe, dim, hot_keys)
        on_cols.append(_S)
    # Unique names on the dictionary side: the refined parts all derive from
    # one dataset, so references must be by name, not by DataFrame.
    dim = dim.select(
        *[F.col(c).alias(f"_d{c}") for c in on_cols + [_LO, _HI]],
        *[F.col(c).alias(f"_dp{i}") for i, c in enumerate(payload)],
    )
    on = F.col("_rl_key").between(F.col(f"_d{_LO}"), F.col(f"_d{_HI}"))
    for c in on_cols:
        on = (F.col(c) == F.col(f"_d{c}")) & on
    if broadcast:
        joined = probe.join(F.broadcast(dim), on, "left")
    else:
        # Measured too large to broadcast: keep Spark from broadcasting it on
        # its own (often optimistic) size estimate of the exploded side.
        joined = probe.join(dim.hint("merge"), on, "left")
    return joined.select(*cols, *[F.col(f"_dp{i}").alias(c) for i, c in enumerate(payload)])


def _without_maps(kind: DataType) -> bool:
    """Whether a value of the type can be hashed (Spark does not hash maps)."""
    if isinstance(kind, MapType):
        return False
    if isinstance(kind, ArrayType):
        return _without_maps(kind.elementType)
    if isinstance(kind, StructType):
        return all(_without_maps(f.dataType) for f in kind.fields)
    return True


def _salted(events: DataFrame, probe: DataFrame, dim: DataFrame, hot_keys: Sequence[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt for the buckets that hold more than one task's
    share of the events. At most one bucket per shuffle partition can, so the
    set that is broadcast is bounded by their number. With ``hot_keys``, only their
    rows get salts, and the ranges that hold one. A stream is not measured."""
    spark = events.sparkSession
    hashable = [F.col(f.name) for f in events.schema.fields if _without_maps(f.dataType)]
    # the same value in every attempt of a task
    spread = F.xxhash64(*hashable) if hashable else F.lit(0)
    probe = probe.withColumn(_B, F.when(F.col("_rl_key").isNull(), -1 - F.pmod(spread, F.lit(1 << 20))).otherwise(F.col(_B)))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    if hot_keys:
        if len(hot_keys) > MAX_HOT_KEYS:
            raise ValueError(f"more than {MAX_HOT_KEYS} hot keys")
        listed = F.array(*[F.lit(int(k)).cast("bigint") for k in hot_keys])
        salts = F.when(F.exists(listed, lambda k: k.between(F.col(_LO), F.col(_HI))), tasks).otherwise(1)
        probe = probe.withColumn(_S, F.when(F.array_contains(listed, F.col("_rl_key")), F.pmod(spread, F.lit(tasks))).otherwise(0).cast("int"))
        return probe, dim.withColumn(_S, F.explode(F.sequence(F.lit(0), salts - 1)))
    if events.isStreaming:
        return probe.withColumn(_S, F.lit(0)), dim.withColumn(_S, F.lit(0))
    shared_dir(spark)
    counts = probe.where(f"{_B} >= 0").groupBy(_LV, _B).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where(F.col("_n") * tasks > total).select(
        F.col(_LV).alias("_h_lv"), F.col(_B).alias("_h_b"), F.ceil(F.col("_n") * tasks / F.lit(max(total, 1))).cast("int").alias("_salts"))
    same = (F.col(_LV) == F.col("_h_lv")) & (F.col(_B) == F.col("_h_b"))
    salts = F.coalesce("_salts", F.lit(1))
    probe = probe.join(F.broadcast(hot), same, "left").withColumn(_S, F.pmod(spread, salts).cast("int")).drop("_h_lv", "_h_b", "_salts")
    dim = dim.join(F.broadcast(hot), same, "left").withColumn(_S, F.explode(F.sequence(F.lit(0), salts - 1))).drop("_h_lv", "_h_b", "_salts")
    return probe, dim


def _refine(dim: DataFrame, probe: DataFrame, bits: int, levels: list[int], dense: int):
    """Re-explode every bucket touched by more than ``dense`` ranges at the
    next, finer width, level by level. Each level is checkpointed, so the
    dictionary is read and refined once. A probe learns its level from a broadcast
    map of the refined buckets."""
    shared_dir(dim.sparkSession)
    done = []
    level_bits = [bits, *levels]
    for lvl, (coarse, fine) in enumerate(zip(level_bits, level_bits[1:])):
        dim = dim.checkpoint(eager=True)
        hot = _dense_buckets(dim, dense).checkpoint(eager=True)
        done.append(dim.join(hot, _B, "left_anti"))
        dim = _finer(dim, coarse, fine, dense, hot).withColumn(_LV, F.lit(lvl + 1))
        # A bit per bucket, 64 to a row. Only a bucket of more than ``dense`` keys can
        # hold so many ranges, so there are at most 2^32 / dense bits.
        words = hot.groupBy(F.shiftright(_B, 6).alias("_rl_word")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast({_B} & 63 AS int))")).alias("_rl_bits")).withColumn("_rl_hot_lv", F.lit(lvl)).checkpoint(eager=True)
        is_hot = F.expr(f"coalesce(shiftright(_rl_bits, cast({_B} & 63 AS int)) & 1, 0) = 1")
        probe = (
            probe.join(F.broadcast(words), (F.shiftright(_B, 6) == F.col("_rl_word")) & (F.col(_LV) == F.col("_rl_hot_lv")), "left")
            .withColumn("_rl_finer", is_hot)
            .withColumn(_B, F.when(F.col("_rl_finer"), F.shiftright("_rl_key", fine)).otherwise(F.col(_B)))
            .withColumn(_LV, F.when(F.col("_rl_finer"), F.lit(lvl + 1)).otherwise(F.col(_LV)))
            .drop("_rl_word", "_rl_bits", "_rl_hot_lv", "_rl_finer")
        )
    out = dim
    for part in done:
        out = out.unionByName(part)
    return out.checkpoint(eager=True), probe
