"""Secret scans with multipart credential linking, in DataFrame functions only.

Three base kinds (assignments, access ids, long hex runs) are strong: they are
always reported. Looser patterns find the parts of a credential: access
identifiers, secret values and endpoints. Such a weak part alone is no finding;
it is reported when a complementary part (of another type, strong or weak) lies
in its scope, that is at most ``SCOPE`` code points away in the same text. This
is an interval join: every part, lengthened by the scope, is put in the bins it
covers, and two parts meet in the bin of the later start only. Texts without
weak parts, or with parts of one type, take no part in the join, and texts are
not shuffled: only their spans are.

Positions come from the lengths of the pieces between the matches; running sums
are built in blocks, so a text with many matches costs little more than linear
time. Defined results: a null text is empty; positions are code points, ends
exclusive; null ids stay; repeated rows give repeated rows; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCOPE = 300
_BLOCK = 64

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: (kind, type, pattern, condition on the match m). The first three are the base.
KINDS = (
    ("assign", "secret", _ASSIGN, "char_length(regexp_extract(m, {pattern}, 2)) >= 6"),
    ("access", "identifier", r"AKIA[A-Z0-9]{16,}", "true"),
    ("hex", "secret", r"[0-9a-f]{24,}", "true"),
    ("identifier", "identifier", r"""(?i:access[_-]?key[_-]?id|client[_-]?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", "true"),
    ("value", "secret", r"[A-Za-z0-9+/_-]{32,}={0,2}", "m rlike '[0-9]' and m rlike '[A-Z]' and m rlike '[a-z]'"),
    ("endpoint", "endpoint", r"""(?i:https?|jdbc|mongodb|redis|amqp|postgresql|mysql)://[A-Za-z0-9][^\x20\x09-\x0D"'<>]*""", "true"),
)
BASE = 3
_EMPTY = "cast(array() as array<struct<start: int, stop: int>>)"


def _literal(pattern: str) -> str:
    """A SQL string literal of a regular expression."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _span_columns(df: DataFrame, carried: list[str]) -> DataFrame:
    """``df`` (with the text ``_t``) with an array of (start, stop) per kind."""
    found = [f"if(_t rlike {_literal(p)}, regexp_extract_all(_t, {_literal(p)}, 0), cast(array() as array<string>)) as _m{i}"
             for i, (_, _, p, _) in enumerate(KINDS)]
    df = df.selectExpr(*carried, "_t", *found)
    # gap before each match and its length; the last gap has no match
    cuts = [f"if(size(_m{i}) = 0, null, arrays_zip(transform(split(_t, {_literal(p)}, -1), x -> char_length(x)), "
            f"transform(_m{i}, m -> char_length(m)), transform(_m{i}, m -> {cond.replace('{pattern}', _literal(p))}))) as _c{i}"
            for i, (_, _, p, cond) in enumerate(KINDS)]
    df = df.selectExpr(*carried, *cuts)
    blocks = [f"if(_c{i} is null, null, transform(sequence(0, (size(_c{i}) - 1) div {_BLOCK}), b -> aggregate(slice(_c{i}, b * {_BLOCK} + 1, {_BLOCK}), "
              "named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, stop: int, ok: boolean>>)), "
              "(a, x) -> named_struct('at', a.at + x.`0` + coalesce(x.`1`, 0), 'spans', "
              "concat(a.spans, array(named_struct('start', a.at + x.`0`, 'stop', a.at + x.`0` + x.`1`, 'ok', x.`2`))))))) as _b" + str(i)
              for i in range(len(KINDS))]
    df = df.selectExpr(*carried, *blocks)
    offsets = [f"if(_b{i} is null, null, aggregate(_b{i}, named_struct('at', 0, 'all', cast(array() as array<int>)), "
               f"(a, b) -> named_struct('at', a.at + b.at, 'all', concat(a.all, array(a.at))), a -> a.all)) as _o{i}" for i in range(len(KINDS))]
    df = df.selectExpr(*carried, *[f"_b{i}" for i in range(len(KINDS))], *offsets)
    spans = [f"coalesce(flatten(zip_with(_b{i}, _o{i}, (b, o) -> transform(filter(b.spans, s -> s.ok), "
             f"s -> named_struct('start', s.start + o, 'stop', s.stop + o)))), {_EMPTY}) as {k}" for i, (k, _, _, _) in enumerate(KINDS)]
    return df.selectExpr(*carried, *spans)


def _tagged(kinds: range) -> str:
    """SQL of one array of (start, rank, stop) of the kinds."""
    return "concat(" + ", ".join(f"transform({KINDS[i][0]}, s -> named_struct('start', s.start, 'rank', {i}, 'stop', s.stop))" for i in kinds) + ")"


def _listed(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k, *_ in KINDS) + ")"
    return f"array_join(transform(array_sort({spans}), s -> concat_ws(':', get({names}, s.rank), s.start, s.stop)), ',')"


def scan_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (hash of the text), strong and weak spans (start, rank, stop) of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("_t"))
    rows = _span_columns(rows, ["doc_id", "key"])
    rows = rows.selectExpr("doc_id", "key", "cast(size(assign) as long) as n_assign", "cast(size(access) as long) as n_access",
                           "cast(size(hex) as long) as n_hex", f"{_tagged(range(BASE))} as strong", f"{_tagged(range(BASE, len(KINDS)))} as weak")
    # a weak match inside or across a strong one is that finding again
    return rows.withColumn("weak", F.expr("filter(weak, w -> not exists(strong, s -> w.start < s.stop and s.start < w.stop))"))


def linked_parts(rows: DataFrame) -> DataFrame:
    """doc_id, key, linked: the weak spans of each row with a complementary part in scope."""
    types = "array(" + ", ".join(f"'{t}'" for _, t, *_ in KINDS) + ")"
    several = rows.where("size(weak) > 0 and size(strong) + size(weak) > 1").select("doc_id", "key", "strong", "weak").dropDuplicates(["doc_id", "key"])
    parts = several.selectExpr("doc_id", "key", "explode(concat(strong, weak)) as p").selectExpr(
        "doc_id", "key", "p", f"get({types}, p.rank) as type",
        f"explode(sequence(p.start div {SCOPE}, (p.stop + {SCOPE}) div {SCOPE})) as bin")
    weak = parts.where(F.col("p.rank") >= BASE).alias("w")
    other = parts.selectExpr("doc_id as o_id", "key as o_key", "bin as o_bin", "p as q", "type as o_type").alias("o")
    met = weak.join(other, (F.col("doc_id").eqNullSafe(F.col("o_id"))) & (F.col("key") == F.col("o_key")) & (F.col("bin") == F.col("o_bin"))
                    & (F.col("type") != F.col("o_type")) & F.expr(f"bin = greatest(p.start, q.start) div {SCOPE}")
                    & F.expr(f"p.start <= q.stop + {SCOPE} and q.start <= p.stop + {SCOPE}"), "left_semi")
    return met.select("doc_id", "key", "p").distinct().groupBy("doc_id", "key").agg(F.collect_list("p").alias("linked"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    rows = scan_rows(docs, id_col, text_col)
    linked = linked_parts(rows).select(F.col("doc_id").alias("l_id"), F.col("key").alias("l_key"), "linked")
    joined = rows.drop("weak").join(linked, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("key") == F.col("l_key")), "left")
    joined = joined.withColumn("linked", F.expr("coalesce(linked, cast(array() as array<struct<start: int, rank: int, stop: int>>))"))
    return joined.selectExpr("doc_id", "n_assign", "n_access", "n_hex", f"sha2({_listed('strong')}, 256) as base_sha256",
                             f"{_listed('concat(strong, linked)')} as spans", "cast(size(linked) as long) as n_linked")


def _oracle() -> str:
    """The same in DuckDB SQL over the view ``documents``."""
    def quoted(p: str) -> str:
        return "'" + p.replace("'", "''") + "'"

    found = []
    for i, (kind, kind_type, p, cond) in enumerate(KINDS):
        cond = cond.replace("char_length", "length").replace("{pattern}", quoted(p))
        for c in ("[0-9]", "[A-Z]", "[a-z]"):
            cond = cond.replace(f"m rlike '{c}'", f"regexp_matches(m, '{c}')")
        found.append(f"""SELECT r, {i} AS rank, '{kind}' AS kind, '{kind_type}' AS type, s AS start, s + length(m) AS stop FROM (
  SELECT r, ms[i] AS m, list_sum(list_transform(ps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT r, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
    SELECT r, regexp_extract_all(t, {quoted(p)}, 0) AS ms, regexp_split_to_array(t, {quoted(p)}) AS ps FROM d)))
WHERE {cond}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS MATERIALIZED ({" UNION ALL ".join(found)}),
parts AS (SELECT * FROM found f WHERE rank < {BASE} OR NOT EXISTS (
  SELECT 1 FROM found s WHERE s.r = f.r AND s.rank < {BASE} AND f.start < s.stop AND s.start < f.stop)),
kept AS (SELECT * FROM parts p WHERE rank < {BASE} OR EXISTS (
  SELECT 1 FROM parts q WHERE q.r = p.r AND q.type <> p.type AND p.start <= q.stop + {SCOPE} AND q.start <= p.stop + {SCOPE})),
agg AS (SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < {BASE}) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans, count(*) FILTER (rank >= {BASE}) AS n_linked
  FROM kept GROUP BY r)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked
FROM d LEFT JOIN agg USING (r)
"""


ORACLE = _oracle()
