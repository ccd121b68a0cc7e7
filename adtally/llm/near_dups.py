"""Near duplicates by BagMinHash, banding and exact multiset verification.

A text is a multiset of five-word shingles. Its weighted minwise signature
comes from Poisson processes over the weights (O. Ertl, "BagMinHash", 2018):
the weight axis is cut into the intervals [0,1), [1,2), [2,4), [4,8), ...; each
(shingle, interval) owns a Poisson process whose rate is the interval's width,
every point of it falls on a random register and on a random place in the
interval, and counts only if that place is below the shingle's weight (halving
the interval level by level is drawing the bits of that place). A register
keeps the earliest point, so two texts agree in a register with probability
equal to their weighted Jaccard similarity. Points after the time by which all
registers are taken never need to be drawn, which makes long texts cheap.

Bands of the signature make buckets. Exact copies are one node from the start;
a bucket of any size gives one candidate per member, with its leader, never all
pairs. Leaders are the members with most meetings, so that a text finds the one
it was copied from. Candidates are verified on the full shingle multisets. Where
a bucket then still holds several components, its next leaders are compared with
the members of other components: all pairs of a bucket of up to ``LEADERS + 1``
members. In a larger one long sketches of the members of different components are
compared, block by block, where their common shingles can be enough: a shingle that
one member alone holds is in no pair's intersection. Pairs that agree are verified
in rounds, the best few of two components first, until every such pair is joined
or tried; of the buckets that two texts share the first one emits them.

Defined results: a null text is empty; words are lower-case alphanumeric runs;
a text of one to four words is one shingle; texts without words are copies only
of the very same text. ``class_id`` is the least doc_id of the class, null if
all its doc_ids are null. Repeated rows are one node and appear as often as in
the input. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import materialize, old_names, own_names, sized_broadcast, steps
from adtally.llm.words import mix, shingle_hashes, word_hashes

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: 24 bands of 4 registers find a pair at similarity 0.8 with probability
#: 1 - (1 - 0.8**4)**24 = 0.999997.
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
#: A pair between components is verified if this many registers agree; at
#: similarity 0.8 (76.8 of 96 expected) it is missed with probability 1e-6.
LEAST_AGREE = 57
#: Registers of 8 bits of the sketches by which all members of a bucket are compared;
#: at similarity 0.8 (820 expected, deviation 12.8) a pair is missed with probability 1e-6.
LONG, LONG_AGREE = 1024, 759
#: Leaders of a bucket that still holds several components.
LEADERS = 8
#: Members of a block of a bucket, of which two meet in one step.
BLOCK = 1000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _unit(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_signatures(hashes: np.ndarray, weights: np.ndarray, doc: np.ndarray, docs: int,
                   registers: int = REGISTERS) -> np.ndarray:
    """Signatures (docs x registers, uint64) of weighted sets.

    ``hashes``: distinct elements per document, ``weights``: their counts,
    ``doc``: their document. A document without elements has zeros.
    """
    total = np.bincount(doc, weights, docs)
    best = np.full(docs * registers, np.inf)
    # one process for each (element, weight interval below the weight)
    levels = np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64) + 1
    owner = np.repeat(np.arange(len(hashes)), levels)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    width = np.where(level == 0, 1.0, low)
    cut, whose = weights[owner].astype(np.float64), doc[owner]
    state = mix(hashes[owner] + level.astype(np.uint64) * _GOLDEN)
    stop = (registers / np.maximum(total, 1)) * (math.log(registers) + 3)

    def advance(state, time, width):
        state = state + _GOLDEN
        bits = mix(state)
        return state, time - np.log(_unit(bits)) / width, mix(bits ^ _GOLDEN)

    state, time, bits = advance(state, np.zeros(len(owner)), width)
    waiting = []  # processes whose next point is after their document's stop
    while True:
        while len(time):
            early = time < stop[whose]
            if not early.all():
                late = ~early
                waiting.append(tuple(x[late] for x in (state, time, bits, width, low, cut, whose)))
                state, time, bits, width, low, cut, whose = (x[early] for x in (state, time, bits, width, low, cut, whose))
                if not len(time):
                    break
            inside = low + width * _unit(mix(bits)) < cut
            np.minimum.at(best, whose[inside] * registers + (bits[inside] % np.uint64(registers)).astype(np.int64), time[inside])
            state, time, bits = advance(state, time, width)
        open_docs = (np.isinf(best.reshape(docs, registers)).any(axis=1)) & (total > 0)
        if not open_docs.any():
            break
        stop[open_docs] *= 2
        merged = [np.concatenate(x) for x in zip(*waiting)]
        again = open_docs[merged[6]]
        waiting = [tuple(x[~again] for x in merged)]
        state, time, bits, width, low, cut, whose = (x[again] for x in merged)
    best[np.isinf(best)] = 0
    return best.view(np.uint64).reshape(docs, registers)


def weighted_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingle hashes, counts, document) and the shingle count of each text."""
    words, first = word_hashes(texts)
    shingles, begin = shingle_hashes(words, first, SHINGLE_WORDS)
    doc = np.repeat(np.arange(len(texts)), np.diff(begin))
    order = np.lexsort((shingles, doc))
    s, d = shingles[order], doc[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return s[at], np.diff(np.append(at, len(s))), d[at], np.diff(begin)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            hashes, counts, doc, n = weighted_shingles(part.column("text"))
            sig = bag_signatures(hashes, counts, doc, part.num_rows)
            bands = np.zeros((part.num_rows, BANDS), np.uint64)
            for j in range(ROWS):
                bands = mix(bands + sig[:, j::ROWS] + np.uint64(((j + 1) * int(_GOLDEN)) & (2**64 - 1)))
            bands = mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN)
            small = (mix(sig) >> np.uint64(48)).astype(np.uint16)
            flat = pa.array(bands.view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays(
                [part.column("fp"),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, part.num_rows * BANDS + 1, BANDS, dtype=np.int32)), flat),
                 pa.array([x.tobytes() for x in small], pa.binary()), pa.array(n, pa.int64())],
                names=["fp", "bands", "sketch", "shingles"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep pairs whose weighted Jaccard similarity is at least THRESHOLD."""
    for batch in batches:
        for part in steps(batch, "text_a", 1 << 20):
            a, b = (weighted_shingles(part.column(c)) for c in ("text_a", "text_b"))
            # the smaller count of a shingle that both texts of a pair hold
            doc = np.concatenate([a[2], b[2]])
            shingle = np.concatenate([a[0], b[0]])
            count = np.concatenate([a[1], b[1]])
            order = np.lexsort((shingle, doc))
            d, s, c = doc[order], shingle[order], count[order]
            both = np.flatnonzero((d[1:] == d[:-1]) & (s[1:] == s[:-1]))
            common = np.bincount(d[both], np.minimum(c[both], c[both + 1]), part.num_rows)
            similar = common >= THRESHOLD * (a[3] + b[3] - common)
            yield part.select(["a", "b"]).filter(pa.array(similar & (common > 0)))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) among ``pairs``; ``texts`` (fp, text) holds each node once."""
    joined = (pairs.join(texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b")), "b"))
    return joined.mapInArrow(_overlaps, "a string, b string")


def _state(edges: DataFrame) -> tuple:
    """Count and two checksums of a set of edges."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 40)))).first())


def components(links: DataFrame) -> DataFrame:
    """(fp, root) for every end of ``links`` (a, b), by alternating large and
    small stars; root is the least node of the component. Joins against the
    least neighbours are broadcast while the edges are within the bound."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(sized_broadcast(least, 2 * state[0]), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(sized_broadcast(least, 2 * state[0]), "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        edges = materialize(small, "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("fp"), F.col("v").alias("root")))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (md5 of the text), class_id, root."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.md5(text.cast("binary")).alias("fp"), text.alias("text"))
    # copies become one node before anything else is shuffled or signed
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "nodes")
    signed = materialize(rows.select("fp", "text").mapInArrow(_sign, "fp string, bands array<long>, sketch binary, shingles long")
                         .where("shingles > 0").dropDuplicates(["fp"]), "signed")
    members = signed.select("fp", F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    held = materialize(members.join(sizes, "band"), "buckets")
    # the member that meets most others leads: the text that copies were made from
    # shares more bands with them than they share with each other
    degree = held.groupBy("fp").agg(F.sum("size").alias("degree"))
    first = Window.partitionBy("band").orderBy(F.desc("degree"), "fp")
    leaders = materialize(held.join(degree, "fp").withColumn("place", F.row_number().over(first)).where(f"place <= {LEADERS}")
                          .select("band", F.col("fp").alias("leader"), "place"), "leaders")
    pairs = materialize(_pairs(held.join(leaders.where("place = 1"), "band")), "pairs")
    needed = materialize(held.select("fp").distinct(), "needed")
    texts = materialize(rows.select("fp", "text").join(sized_broadcast(needed), "fp", "left_semi").dropDuplicates(["fp"]), "texts")
    links = materialize(_verified(pairs, texts), "links")
    labels = materialize(components(links), "labels")
    bridges = materialize(_bridges(held, leaders, labels, pairs, signed, texts), "bridges")
    if bridges.take(1):
        labels = _merged(labels, bridges)
    labels = _joined_in_full(held.where(F.col("size") > LEADERS + 1), labels, pairs, signed, texts)
    rooted = nodes.join(sized_broadcast(labels), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    named = rooted.join(classes, "root").select("fp", "class_id", "root")
    return rows.select("doc_id", "fp").join(named, "fp").select("doc_id", "class_id", "fp", "root")


def _merged(labels: DataFrame, bridges: DataFrame) -> DataFrame:
    """``labels`` after the components that ``bridges`` (a, b) join have become one."""
    named = sized_broadcast(labels)
    ends = [named.select(F.col("fp").alias(c), F.col("root").alias(f"r{c}")) for c in ("a", "b")]
    between = bridges.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    higher = components(between).select(F.col("fp").alias("root"), F.col("root").alias("top"))
    moved = labels.join(higher, "root", "left").select("fp", F.coalesce("top", "root").alias("root"))
    # ends that had no link before
    new = higher.select(F.col("root").alias("fp"), F.col("top").alias("root")).join(labels, "fp", "left_anti")
    return materialize(moved.unionByName(new), "labels")


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of members and leaders."""
    return (met.where("fp <> leader").select(F.least("fp", "leader").alias("a"), F.greatest("fp", "leader").alias("b")).distinct())


def _bridges(held: DataFrame, leaders: DataFrame, labels: DataFrame, tried: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components that share a bucket: its further leaders meet
    its members of other components."""
    labels = sized_broadcast(labels)
    labelled = materialize(held.join(labels, "fp", "left").select("band", "fp", F.coalesce("root", "fp").alias("root")), "labelled")
    mixed = labelled.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("band")
    inside = labelled.join(mixed, "band", "left_semi")
    named = leaders.join(labels, leaders["leader"] == labels["fp"], "left").select("band", "leader", F.coalesce("root", "leader").alias("leader_root"))
    pairs = _pairs(inside.join(named, "band").where("root <> leader_root")).join(tried, ["a", "b"], "left_anti")
    sketches = signed.select("fp", "sketch")
    pairs = (pairs.join(sketches.select(F.col("fp").alias("a"), F.col("sketch").alias("sa")), "a")
             .join(sketches.select(F.col("fp").alias("b"), F.col("sketch").alias("sb")), "b")
             .mapInArrow(_agreeing, "a string, b string"))
    return _verified(materialize(pairs, "bridge-pairs"), texts)


def _joined_in_full(held: DataFrame, labels: DataFrame, tried: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """``labels`` after every pair of a bucket of ``held`` that can be similar is in one component or verified.

    A round takes a number of pairs of two components and block pair, the best
    first, and the next one four times as many of the buckets that had more; it is
    the last if none had."""
    mixed = _mixed(held, labels)
    if mixed is None:
        return labels
    traits = _traits(mixed.select("fp").distinct(), signed, texts)  # later rounds have no other members
    held = materialize(held.select("band", "fp").join(traits.select("fp"), "fp", "left_semi"), "able")
    most = 4 * LEADERS
    while True:
        mixed = _mixed(held, labels)
        if mixed is None:
            return labels
        found = materialize(_cells(mixed, traits).groupBy("band", "i", "j").applyInArrow(_crossing(most), "a string, b string, band long, more boolean"), "crossing")
        fresh = materialize(found.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "fresh")
        links = materialize(_verified(fresh, texts), "links")
        if links.take(1):
            labels = _merged(labels, links)
        unfinished = materialize(found.where("more").select("band").distinct(), "unfinished")
        if not unfinished.take(1):
            return labels
        held = held.join(sized_broadcast(unfinished), "band", "left_semi")
        tried, most = tried.unionByName(fresh), 4 * most


def _mixed(held: DataFrame, labels: DataFrame) -> DataFrame | None:
    """(band, fp, root, top, inside, outside): the members of the buckets that hold
    several components, the largest one and how many blocks it and the others make."""
    labelled = held.join(sized_broadcast(labels), "fp", "left").select("band", "fp", F.coalesce("root", "fp").alias("root"))
    labelled = materialize(labelled, "labelled")
    sizes = labelled.groupBy("band", "root").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("band").agg(F.count("*").alias("roots"), F.sum("n").alias("total"), F.max(F.struct("n", "root")).alias("top")).where("roots > 1")
    mixed = materialize(mixed.select("band", F.col("top.root").alias("top"), F.ceil(F.col("top.n") / BLOCK).cast("int").alias("inside"),
                                     F.ceil((F.col("total") - F.col("top.n")) / BLOCK).cast("int").alias("outside")), "mixed")
    n = mixed.count()
    return labelled.join(sized_broadcast(mixed, n), "band") if n else None


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            hashes, counts, doc, _ = weighted_shingles(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("fp").take(pa.array(doc)), pa.array(hashes.view(np.int64)), pa.array(counts)], names=["fp", "shingle", "n"])


def _long_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            hashes, counts, doc, _ = weighted_shingles(part.column("text"))
            codes = (mix(bag_signatures(hashes, counts, doc, part.num_rows, LONG)) >> np.uint64(56)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([part.column("fp"), pa.array([x.tobytes() for x in codes], pa.binary())], names=["fp", "long"])


def _traits(members: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """(fp, bands, long, shingles, free) of the members that can have a partner among
    them. free: shingles that another member holds too. What two texts share is free
    in both, so a text less than ``THRESHOLD`` of which is free is similar to none."""
    members = materialize(members, "members")
    asked = texts.join(sized_broadcast(members), "fp", "left_semi")
    rows = asked.mapInArrow(_shingle_rows, "fp string, shingle long, n long")
    alone = rows.groupBy("shingle").agg(F.count("*").alias("texts"), F.min("n").alias("n"), F.min(F.unhex("fp")).alias("fp")).where("texts = 1")
    alone = materialize(alone.groupBy("fp").agg(F.sum("n").alias("alone")).select(F.lower(F.hex("fp")).alias("fp"), "alone"), "alone")
    free = F.col("shingles") - F.coalesce("alone", F.lit(0))
    able = signed.join(sized_broadcast(members), "fp", "left_semi").join(sized_broadcast(alone), "fp", "left").select("fp", "bands", "shingles", free.alias("free"))
    able = able.where(F.col("free") >= F.lit(THRESHOLD) * F.col("shingles"))
    sketches = asked.mapInArrow(_long_sketches, "fp string, long binary")
    return materialize(able.join(sketches, "fp"), "traits")


def _cells(mixed: DataFrame, traits: DataFrame) -> DataFrame:
    """(band, i, j, own, fp, root and traits): the members of blocks i and j of a
    bucket of several components. Blocks of its largest one have numbers below
    zero and do not meet each other."""
    rows = mixed.withColumn("largest", F.col("root") == F.col("top"))
    h = F.xxhash64("fp")
    rows = rows.withColumn("own", F.when(F.col("largest"), -1 - F.pmod(h, F.col("inside"))).otherwise(F.pmod(h, F.col("outside"))).cast("int"))
    others = F.sequence(F.lit(0), F.col("outside") - 1)
    met = F.when(F.col("largest"), F.transform(others, lambda y: F.struct(y.alias("i"), F.col("own").alias("j")))).otherwise(F.concat(
        F.transform(others, lambda y: F.struct(F.least("own", y).alias("i"), F.greatest("own", y).alias("j"))),
        F.transform(F.sequence(F.lit(1), F.col("inside")), lambda y: F.struct(F.col("own").alias("i"), (-y).alias("j")))))
    rows = rows.select("band", "fp", "root", "own", met.alias("met")).join(traits, "fp")
    return rows.select("*", F.explode("met").alias("cell")).select("band", "cell.i", "cell.j", "own", "fp", "root", "bands", "long", "shingles", "free")


def _crossing(most: int):
    """Pairs of a cell whose long sketches agree and whose components differ: up to
    ``most`` of two components, by agreement; ``more``: some were left out. Of the
    buckets that two texts share only the first emits them."""
    def run(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        own, i, j, band = cell["own"].to_numpy(), cell["i"][0].as_py(), cell["j"][0].as_py(), cell["band"][0].as_py()
        names = np.array(cell["fp"].to_pylist(), object)
        order = np.argsort(names)
        names, own = names[order], own[order]
        root = np.unique(np.array(cell["root"].to_pylist(), object), return_inverse=True)[1][order]
        bands = cell["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)[order]
        sketch = np.frombuffer(b"".join(cell["long"].to_pylist()), np.uint8).reshape(-1, LONG)[order]
        size, free = cell["shingles"].to_numpy()[order], cell["free"].to_numpy()[order]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        parts = []
        for x in left:
            # no more than what is free in both can be common
            able = np.minimum(free[right], free[x]) * (1 + THRESHOLD) >= THRESHOLD * (size[right] + size[x])
            to = right[able & (root[right] != root[x]) & ((right > x) if i == j else True)]
            same = bands[to] == bands[x]
            to = to[bands[x][same.argmax(axis=1)] == band] if len(to) else to
            agree = (sketch[to] == sketch[x]).sum(axis=1)
            good = agree >= LONG_AGREE
            parts.append((np.full(int(good.sum()), x), to[good], agree[good]))
        x, y, agree = (np.concatenate(c) if parts else np.zeros(0, np.int64) for c in (list(zip(*parts)) or [()] * 3))
        two = np.minimum(root[x], root[y]) * len(names) + np.maximum(root[x], root[y])
        by = np.lexsort((y, x, -agree, two))
        x, y, two = x[by], y[by], two[by]
        first = np.flatnonzero(np.append(True, two[1:] != two[:-1])) if len(two) else np.zeros(0, np.int64)
        nth = np.arange(len(two)) - np.repeat(first, np.diff(np.append(first, len(two))))
        kept = nth < most
        a, b = names[np.minimum(x, y)[kept]].tolist(), names[np.maximum(x, y)[kept]].tolist()
        more = not kept.all()
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "band": pa.array([band] * len(a), pa.int64()), "more": pa.array([more] * len(a), pa.bool_())})

    return run


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("sa", "sb"))
        yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= LEAST_AGREE))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the first of its least (doc_id, fp)."""
    classes = near_duplicate_classes(docs, id_col, text_col)
    keep = materialize(classes.groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("k"))
                       .select(F.col("k.doc_id").alias("_kept_id"), F.col("k.fp").alias("_kept_fp")), "kept")
    renamed, names = own_names(docs)
    fp = F.md5(F.coalesce(F.col(names[text_col]).cast("string"), F.lit("")).cast("binary"))
    marked = renamed.withColumn("_near_fp", fp)
    kept = marked.join(keep, (F.col("_near_fp") == F.col("_kept_fp")) & F.col(names[id_col]).eqNullSafe(F.col("_kept_id")), "left_semi")
    return old_names(kept.dropDuplicates([names[id_col], "_near_fp"]), names)
