"""Merkle manifest of a dataset with inclusion proofs, checkpoint and recompute.

Every row is a leaf: the hash of its fields, each written with its length. The
leaves of a group ascend by an order column; two consecutive nodes (the last one
alone, if need be) become their hash until one is left, the group's subroot; the
subroots, ordered by group, become the root likewise.

Only every ``STORED`` th level is stored. A stored node is the top of an aligned
subtree of up to ``2 ** STORED`` stored nodes of the level below; proofs are made
from the top down: the subtree's missing nodes are computed again from its stored
ones, the siblings of each are read off and put before those of the node above,
and the regenerated nodes are dropped with the row. A task holds one subtree.

Ranks within a group come from a range shuffle and the sums of its partitions,
so that a group of any size is spread; no window runs over a group's rows.

Defined results: a null field is hashed as ``-``, a null group is the first
group, a null order value the first of its group; rows that are equal in group
and order ascend by their leaf; equal rows are leaves of their own, next to each
other, whose proofs may differ. Texts of any length are hashed whole. An empty
table has no rows and no root. Extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import materialize, sized_broadcast

#: Levels from one stored level to the next; a subtree has up to 2**STORED nodes.
STORED = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the strings one after the other."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return digest(*map(encoded, fields))


def fold(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings, lowest first, lead to."""
    def up(node: Column, s: Column) -> Column:
        return digest(F.when(s["left"], F.concat(s["digest"], node)).otherwise(F.concat(node, F.coalesce(s["digest"], F.lit("")))))

    return F.aggregate(siblings, leaf, up)


def proof_digest(siblings: Column) -> Column:
    """The hash of all siblings that exist, lowest level first."""
    return F.sha2(F.concat_ws("", F.transform(siblings, lambda s: s["digest"])), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: group, pos, size, digest and carried columns of every row.
    ``groups`` and ``top``: the stored levels of the trees of the groups and of
    their subroots, leaves first; the last level of ``top`` holds the root."""

    groups: list[DataFrame]
    top: list[DataFrame]
    carried: tuple[str, ...]

    @property
    def root(self) -> DataFrame:
        """One row with the column ``root``; none for an empty table."""
        return self.top[-1].select(F.col("digest").alias("root"))


def _ranked(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` with ``pos``, the rank within ``grp``, and ``size``, the group's rows."""
    keys = ["grp", *order, "_scan"]
    nodes = nodes.withColumn("_scan", F.monotonically_increasing_id())  # splits a run of equal rows
    # monotonically_increasing_id: the partition above bit 33, the row in it below.
    dealt = materialize(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_scan").withColumn("_at", F.monotonically_increasing_id()), f"{name}-dealt")
    part = F.shiftright("_at", 33).alias("_part")
    spans = dealt.groupBy("grp", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    parts = Window.partitionBy("grp")  # a row per partition of the range shuffle, not per leaf
    before = F.sum("_rows").over(parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    spans = materialize(spans.select("grp", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(parts).alias("size")), f"{name}-spans")
    rows = dealt.withColumn("_part", part).join(sized_broadcast(spans), ["grp", "_part"])
    return rows.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _blocks(level: DataFrame, depth: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """A row per aligned subtree: its stored nodes and ``levels``, how many levels of it exist."""
    height = F.when(F.col("size") > 1, F.length(F.bin(F.col("size") - 1))).otherwise(0)
    levels = F.least(F.lit(STORED), F.greatest(F.lit(0), F.max(height) - depth))
    nodes = F.sort_array(F.collect_list(F.struct("pos", "digest", *carried)))
    return level.groupBy("grp", F.shiftright("pos", STORED).alias("block")).agg(
        F.max("size").alias("size"), levels.cast("int").alias("levels"), nodes.alias("nodes"))


#: The levels of a block, stored one first; each node from the two below it.
_REGENERATED = f"""
aggregate(slice(sequence(1, {STORED}), 1, levels), array(nodes.digest), (acc, i) -> concat(acc, array(
  transform(sequence(0, (size(element_at(acc, -1)) - 1) div 2),
            x -> sha2(concat(get(element_at(acc, -1), 2 * x), coalesce(get(element_at(acc, -1), 2 * x + 1), '')), 256)))))
"""
#: For node ``it`` of the block with the levels ``lv``: its sibling on each level, null where it has none.
_SIBLINGS = f"""
transform(slice(sequence(0, {STORED - 1}), 1, levels), l -> named_struct(
  'left', (shiftright(it.pos, l) & 1) = 1,
  'digest', get(get(lv, l), cast((shiftright(it.pos, l) & shiftright({2 ** STORED - 1}, l)) ^ 1 as int))))
"""


def _climb(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The stored levels from the leaves to the level on which each group has one node."""
    out = [leaves]
    most = leaves.agg(F.max("size")).first()[0] or 1
    for depth in range(0, (most - 1).bit_length(), STORED):
        tops = _blocks(out[-1], depth).select(
            "grp", F.col("block").alias("pos"), "size", F.expr(f"element_at(element_at({_REGENERATED}, -1), 1)").alias("digest"))
        out.append(materialize(tops, f"{name}-level{depth + STORED}"))
    return out


def _descend(levels: list[DataFrame], above: DataFrame, carried: tuple[str, ...], name: str) -> DataFrame:
    """Proofs of the lowest level: grp, pos, digest, carried columns, and from
    ``above`` (grp, siblings and more, a row per group) the siblings with those of
    all levels before them."""
    more = [c for c in above.columns if c not in ("grp", "siblings")]
    above = above.withColumn("block", F.lit(0).cast("long"))
    for i in reversed(range(len(levels) - 1)):
        own = carried if i == 0 else ()
        fields = ", ".join(f"'{c}', it.`{c}`" for c in ("pos", "digest", *own))
        # The regenerated levels are bound once, as the variable lv of a one-element transform.
        made = f"get(transform(array({_REGENERATED}), lv -> transform(nodes, it -> named_struct({fields}, 'own', {_SIBLINGS}))), 0)"
        # A block of the level is one node of the level above, whose proof is in ``above``.
        rows = _blocks(levels[i], i * STORED, own).join(above, ["grp", "block"])
        rows = rows.select("grp", *more, "siblings", F.inline(F.expr(made)))
        rows = rows.select("grp", "pos", "digest", *own, *more, F.concat("own", "siblings").alias("siblings"))
        if i == 0:
            return rows
        above = materialize(rows.select("grp", F.col("pos").alias("block"), "siblings", *more), f"{name}-proofs{i * STORED}")
    rows = levels[0].join(above.drop("block"), "grp")  # every group is a single leaf
    return rows.select("grp", "pos", "digest", *carried, *more, "siblings")


def build_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None) -> Manifest:
    """Hash every row and store every ``STORED`` th level of the trees. ``carry``
    names expressions over ``docs`` that the leaves keep beside the order column."""
    carry = {order: F.col(f"`{order}`")} | (carry or {})
    grp = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))  # null first, then bytewise
    names = {f"_c{i}": c for i, c in enumerate(carry.values())}
    leaves = docs.select(grp.alias("grp"), leaf_hash(*[F.col(f"`{c}`") for c in fields]).alias("digest"), *[c.alias(n) for n, c in names.items()])
    leaves = _ranked(leaves, ["_c0", "digest"], "merkle-leaves")
    groups = _climb(leaves, "merkle")
    subroots = groups[-1].select(F.lit("").alias("grp"), F.col("grp").alias("_group"), "digest")
    return Manifest(groups, _climb(_ranked(subroots, ["_group"], "merkle-subroots"), "merkle-top"), tuple(carry))


def inclusion_proofs(manifest: Manifest) -> DataFrame:
    """A row per leaf: the order column and the carried ones, leaf, subroot, root,
    and siblings (left, digest; lowest level first, digest null where a node is alone)."""
    none = "array<struct<left:boolean,digest:string>>"
    start = manifest.top[-1].select("grp", F.col("digest").alias("root"), F.array().cast(none).alias("siblings"))
    top = _descend(manifest.top, start, ("_group",), "merkle-top")
    above = top.select(F.col("_group").alias("grp"), "root", F.col("digest").alias("subroot"), "siblings")
    carried = tuple(f"_c{i}" for i in range(len(manifest.carried)))
    rows = _descend(manifest.groups, materialize(above, "merkle-subroots"), carried, "merkle")
    return rows.select(*[F.col(n).alias(c) for n, c in zip(carried, manifest.carried)], F.col("digest").alias("leaf"), "subroot", "root", "siblings")


def tampered(fields: tuple[str, ...] = FIELDS, count: str = "n_chars", order: str = "doc_id", every: int = 7) -> Column:
    """The leaf of a row whose ``count`` is one more, null where crc32 of the order
    value is no multiple of ``every``; a null ``count`` stays null."""
    plus = {count: F.col(f"`{count}`").cast("decimal(38,0)") + 1}
    leaf = leaf_hash(*[plus.get(c, F.col(f"`{c}`")) for c in fields])
    return F.when(F.crc32(F.col(f"`{order}`").cast("string").cast("binary")) % every == 0, leaf)


def audit(docs: DataFrame) -> DataFrame:
    """Build the manifest of ``docs``, prove every row, and check the proof of each
    against the root, of every seventh with a changed ``n_chars``."""
    proofs = inclusion_proofs(build_manifest(docs, carry={"altered": tampered()}))
    folded = fold(F.coalesce("altered", "leaf"), F.col("siblings"))
    rows = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("siblings")).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(name: str, value: str | None = None) -> str:
    v = f"CAST({value or name} AS VARCHAR)"
    return f"coalesce(strlen({v}) || ':' || {v}, '-')"


_SQL_LEAF = "sha256({})"
_SQL_FOLD = "list_reduce([{leaf}] || sibs, lambda a, s: CASE WHEN s[1] = 'L' THEN sha256(s[2:] || a) WHEN s[1] = 'R' THEN sha256(a || s[2:]) ELSE sha256(a) END)"

#: DuckDB: the trees whole, level by level. crc32 goes bit by bit over the characters.
ORACLE = f"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS r, doc_id, lang, {_SQL_LEAF.format(' || '.join(map(_sql_field, FIELDS)))} AS leaf,
    {_SQL_LEAF.format(' || '.join(_sql_field(f, 'n_chars + 1' if f == 'n_chars' else None) for f in FIELDS))} AS other,
    xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
        lambda s, v: CASE WHEN xor(s, v) % 2 = 1 THEN xor(xor(s, v) // 2, 3988292384) ELSE xor(s, v) // 2 END)) AS crc FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
t(lang, lvl, pos, digest, n) AS (
    SELECT lang, 0, pos, leaf, n FROM k
    UNION ALL
    SELECT lang, lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
s AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(lvl, pos, digest, n) AS (
    SELECT 0, pos, subroot, n FROM s
    UNION ALL
    SELECT lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, pos // 2, n),
a AS (
    SELECT k.r, 0 AS tree, own.lvl, CASE WHEN sib.digest IS NULL THEN '-' WHEN own.pos % 2 = 1 THEN 'L' || sib.digest ELSE 'R' || sib.digest END AS sib
    FROM k JOIN t own ON own.lang IS NOT DISTINCT FROM k.lang AND own.pos = k.pos // (2 ** own.lvl)::BIGINT AND own.n > 1
    LEFT JOIN t sib ON sib.lang IS NOT DISTINCT FROM own.lang AND sib.lvl = own.lvl AND sib.pos = xor(own.pos, 1)
    UNION ALL
    SELECT k.r, 1, own.lvl, CASE WHEN sib.digest IS NULL THEN '-' WHEN own.pos % 2 = 1 THEN 'L' || sib.digest ELSE 'R' || sib.digest END
    FROM k JOIN s ON s.lang IS NOT DISTINCT FROM k.lang JOIN u own ON own.pos = s.pos // (2 ** own.lvl)::BIGINT AND own.n > 1
    LEFT JOIN u sib ON sib.lvl = own.lvl AND sib.pos = xor(own.pos, 1)),
p AS (SELECT r, list(sib ORDER BY tree, lvl) AS sibs FROM a GROUP BY r),
f AS (SELECT k.doc_id, k.leaf, s.subroot, (SELECT digest FROM u WHERE n = 1) AS root, coalesce(p.sibs, []) AS sibs, CASE WHEN crc % 7 = 0 THEN other ELSE leaf END AS start
    FROM k JOIN s ON s.lang IS NOT DISTINCT FROM k.lang LEFT JOIN p USING (r)),
g AS (SELECT *, {_SQL_FOLD.format(leaf='start')} AS folded_root FROM f)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(sibs, lambda x: x[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM g
"""
