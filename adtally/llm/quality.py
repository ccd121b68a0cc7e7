"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per text: word, symbol, repeated-line and repeated-window counts and the base
rules. Across texts: normalised lines are hashed and counted per host (the
``source`` column); a line is boilerplate of its host if enough different
documents hold it. Boilerplate lines are taken out, and a document that is
depleted by that is rejected.

Copies and near copies of one page are no evidence of boilerplate. Exact copies
are one text. Of the texts of a host that hold a line, one counts only if it is
no near copy of one that counts by a lesser key; what is compared is the rest of
the texts, without the line in question: a sample of its three-word windows (the
least hash of each of ``SAMPLES`` classes), found by bands and compared in full.
So a large group of copies does not reject itself, and neither a line that is
most of its texts nor the size of a host hides boilerplate.

Defined results: a null text has no words; a null source is a host of its own;
null doc_ids stay; repeated rows give repeated rows; an empty table gives an
empty result; further columns are ignored (``keep_documents`` returns them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import materialize, old_names, own_names, sized_broadcast

#: Base rules.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: A line is boilerplate of a host from this many different documents on.
LINE_DOCUMENTS = 10
#: Near copies: this share of the samples of either text is the same.
NEAR_PERCENT = 60
#: Samples of a text, and how many of them a band has.
SAMPLES, BAND = 64, 4
#: Depleted: fewer words than LEAST_WORDS are left, and more than this share
#: of the words went with boilerplate lines.
DEPLETED_PERCENT = 30

_GAP = r"[\x20\x09-\x0D]+"
_METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.col(text), _GAP), "")


def with_metrics(df: DataFrame, text: str = "_text") -> DataFrame:
    """``df`` with the metrics of the column ``text`` (not null) and base_failed.

    The steps are projections of their own, so that no array is computed again
    inside a lambda. Windows are compared by a 64-bit hash; only a text in
    which one occurs twice is sorted.
    """
    kept = df.columns
    df = df.select(*kept, _words(text).alias("_words"))
    df = df.select(*kept, "_words", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
                   F.filter(F.split(F.col(text), "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    df = df.select(
        *kept, F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace(text, _GAP, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.slice(F.transform("_hashes", lambda h, i: F.xxhash64(h, F.get("_hashes", i + 1), F.get("_hashes", i + 2))),
                F.lit(1), F.greatest(F.size("_hashes") - 2, F.lit(0))).alias("_windows"))
    done = [c for c in df.columns if c != "_windows"]
    df = df.select(*done, F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"))
    twice = F.transform("_sorted", lambda e, j: F.when(
        (e["h"] == F.get("_sorted", j - 1)["h"]) | (e["h"] == F.get("_sorted", j + 1)["h"]), e["i"]))
    df = df.select(*done, F.array_compact(twice).alias("_at"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_at", lambda i: F.array(i, i + 1, i + 2)))))
    df = df.select(*done, F.when(F.col("_at").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"))
    return df.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                         | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))


def _cut_lines(rows: DataFrame, *kept: str) -> DataFrame:
    """A row per line with a word: the columns ``kept``, at, line (hash), _line (normalised)."""
    cut = rows.select(*kept, F.split("_text", "\n").alias("_lines"))
    cut = cut.select(*kept, F.posexplode("_lines").alias("at", "_line"))
    cut = cut.where(F.col("_line").rlike(r"[^\x20\x09-\x0D]"))
    cut = cut.select(*kept, "at", F.trim(F.lower(F.regexp_replace("_line", _GAP, " "))).alias("_line"))
    # two hashes of 96 bits together name a line
    return cut.select(*kept, "at", F.struct(F.xxhash64("_line").alias("a"), F.hash("_line").alias("b")).alias("line"), "_line")


def line_rows(rows: DataFrame) -> DataFrame:
    """A row per line with a word: host, doc_id, key, at, line (hash), words."""
    cut = _cut_lines(rows, "host", "doc_id", "key")
    return cut.select("host", "doc_id", "key", "at", "line", F.size(F.split("_line", " ")).cast("long").alias("words"))


def _samples(texts: DataFrame) -> DataFrame:
    """(key, samples) of ``texts`` (key, _text): for each class of window hashes
    the least hash, its line, and the least hash outside that line."""
    cut = _cut_lines(texts, "key").select("key", "line", F.transform(F.split("_line", " "), lambda w: F.xxhash64(w)).alias("_hashes"))
    windows = F.slice(F.transform("_hashes", lambda h, i: F.xxhash64(h, F.get("_hashes", i + 1), F.get("_hashes", i + 2))),
                      F.lit(1), F.greatest(F.size("_hashes") - 2, F.lit(1)))
    found = cut.select("key", "line", F.explode(windows).alias("h"))
    least = found.groupBy("key", F.pmod("h", F.lit(SAMPLES)).cast("int").alias("class"), "line").agg(F.min("h").alias("h"))
    least = least.groupBy("key", "class").agg(F.sort_array(F.collect_list(F.struct("h", "line"))).alias("_all"))
    # the same window may stand in several lines: it is there without one of them
    least = least.select("key", F.struct("class", F.get("_all", F.lit(0)).alias("first"), F.get("_all", F.lit(1))["h"].alias("next")).alias("s"))
    return least.groupBy("key").agg(F.collect_list("s").alias("_s")).select("key", F.map_from_entries(
        F.transform("_s", lambda s: F.struct(s["class"], F.struct(s["first"]["h"].alias("h"), s["first"]["line"].alias("line"), s["next"].alias("next"))))).alias("samples"))


def _copied(nodes: DataFrame) -> DataFrame:
    """(host, line, key) of the ``nodes`` (host, line, key, rest) that are near
    copies of a text with a lesser key; ``rest``: samples without the line.

    Every text meets the one of least key in each of its bands, so a group of
    any size makes pairs in proportion to its size."""
    bands = F.array(*[F.when(F.size(F.array_compact(part)) > 0, F.struct(F.lit(i).alias("i"), F.xxhash64(part).alias("h")))
                      for i, part in ((i, F.slice("rest", i + 1, BAND)) for i in range(0, SAMPLES, BAND))])
    # texts of nothing else than the line are alike
    bands = F.when(F.size(F.array_compact("rest")) > 0, F.array_compact(bands)).otherwise(F.array(F.struct(F.lit(-1).alias("i"), F.lit(0).cast("long").alias("h"))))
    dealt = nodes.select("host", "line", "key", F.explode(bands).alias("band"))
    first = dealt.groupBy("host", "line", "band").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first.select(F.col("host").alias("_host"), F.col("line").alias("_line"), F.col("band").alias("_band"), "first"), "bands")
    met = dealt.join(first, (F.col("line") == F.col("_line")) & (F.col("band") == F.col("_band")) & F.col("host").eqNullSafe(F.col("_host")))
    pairs = met.where("key > first").select("host", "line", "key", "first").distinct()
    own, other = (nodes.select(F.col("host").alias(f"_h{i}"), F.col("line").alias(f"_l{i}"), F.col("key").alias(f"_k{i}"), F.col("rest").alias(f"rest{i}")) for i in (0, 1))
    for side, at, i in ((own, "key", 0), (other, "first", 1)):
        pairs = pairs.join(side, (F.col("line") == F.col(f"_l{i}")) & (F.col(at) == F.col(f"_k{i}")) & F.col("host").eqNullSafe(F.col(f"_h{i}")))
    both = F.arrays_zip("rest0", "rest1")
    same = F.size(F.filter(both, lambda x: x["rest0"] == x["rest1"]))
    either = F.size(F.filter(both, lambda x: x["rest0"].isNotNull() | x["rest1"].isNotNull()))
    return pairs.where(100 * same >= NEAR_PERCENT * either).select("host", "line", "key").distinct()


def boilerplate_lines(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """(host, line) of the lines that enough different documents of a host hold.

    Each level is pre-aggregated before its shuffle; the first is spread by
    text, so a line of a third of all rows is no hot key. Only texts that hold a
    line of enough texts are compared.
    """
    texts = lines.select("host", "line", "key").distinct()
    common = texts.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= LINE_DOCUMENTS)
    common = materialize(common.select(F.col("host").alias("_host"), F.col("line").alias("_line")), "common")
    n = common.count()
    held = materialize(texts.join(sized_broadcast(common, n), (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")), "left_semi"), "held")
    keys = materialize(held.select("key").distinct(), "keys")
    samples = _samples(rows.join(sized_broadcast(keys), "key", "left_semi").select("key", "_text").dropDuplicates(["key"]))
    rest = F.transform(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), lambda i: F.col("samples")[i])
    nodes = held.join(samples, "key").select("host", "line", "key", rest.alias("_rest"))
    nodes = materialize(nodes.select("host", "line", "key", F.transform(
        "_rest", lambda s: F.when(s["line"] == F.col("line"), s["next"]).otherwise(s["h"])).alias("rest")), "rests")
    copied = _copied(nodes).select(F.col("host").alias("_host"), F.col("line").alias("_line"), F.col("key").alias("_key"))
    different = held.join(copied, (F.col("line") == F.col("_line")) & (F.col("key") == F.col("_key")) & F.col("host").eqNullSafe(F.col("_host")), "left_anti")
    return different.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= LINE_DOCUMENTS).select("host", "line")


def _rows(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.xxhash64(text).alias("key"), text.alias("_text"))


def boilerplate_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(host, doc_id, key, boilerplate_words) of the documents that hold boilerplate lines."""
    rows = _rows(docs, id_col, text_col, host_col)
    lines = materialize(line_rows(rows), "lines")
    frequent = materialize(boilerplate_lines(lines, rows).select(F.col("host").alias("_host"), F.col("line").alias("_line")), "boilerplate")
    met = lines.join(sized_broadcast(frequent), (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")), "left_semi")
    # repeated rows have the same lines at the same places: counted once
    once = met.select("host", "doc_id", "key", "at", "words").distinct()
    return once.groupBy("host", "doc_id", "key").agg(F.sum("words").alias("boilerplate_words"))


def _depleted(n_words: Column, gone: Column) -> Column:
    return (n_words - gone < LEAST_WORDS) & (100 * gone > DEPLETED_PERCENT * n_words)


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    gone = boilerplate_words(docs, id_col, text_col, host_col).select(
        F.col("host").alias("_h"), F.col("doc_id").alias("_i"), F.col("key").alias("_k"), "boilerplate_words")
    rows = with_metrics(_rows(docs, id_col, text_col, host_col)).drop("_text")
    same = (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("host").eqNullSafe(F.col("_h"))
    joined = rows.join(gone, same, "left").withColumn("boilerplate_words", F.coalesce("boilerplate_words", F.lit(0)).cast("long"))
    return joined.withColumn("kept", ~F.col("base_failed") & ~_depleted(F.col("n_words"), F.col("boilerplate_words")))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, the metrics, base_failed,
    boilerplate_words, kept."""
    return _judged(docs, id_col, text_col, host_col).select("doc_id", *_METRICS, "base_failed", "boilerplate_words", "kept")


def keep_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all columns."""
    # written first: a filter on the verdict would be pushed below the metrics
    # and would have their arrays computed again inside its lambdas
    judged = materialize(_judged(docs, id_col, text_col, host_col).select("host", "doc_id", "key", "kept"), "judged")
    rejected = judged.where("not kept").select(F.col("host").alias("_h"), F.col("doc_id").alias("_i"), F.col("key").alias("_k")).distinct()
    renamed, names = own_names(docs)
    same = ((F.xxhash64(F.coalesce(F.col(names[text_col]).cast("string"), F.lit(""))) == F.col("_k")) & F.col(names[id_col]).eqNullSafe(F.col("_i"))
            & F.col(names[host_col]).cast("string").eqNullSafe(F.col("_h")))
    kept = renamed.join(sized_broadcast(rejected), same, "left_anti")
    return old_names(kept, names)


#: The rules in DuckDB SQL over the view ``documents``. A line counts for every
#: different text there; the code leaves near copies of a text out of that count,
#: which changes no row where fewer than LINE_DOCUMENTS of them hold a line.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
tri AS (SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
        FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
real AS (SELECT r, line, trim(lower(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
         FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM real GROUP BY r),
held AS (SELECT d.host, real.norm, d.t, d.r FROM real JOIN d USING (r)),
freq AS (SELECT host, norm FROM held GROUP BY host, norm HAVING count(DISTINCT t) >= {LINE_DOCUMENTS}),
gone AS (SELECT r, sum(len(string_split(norm, ' '))) AS n FROM held h
         WHERE EXISTS (SELECT 1 FROM freq f WHERE f.norm = h.norm AND f.host IS NOT DISTINCT FROM h.host) GROUP BY r),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(gone.n, 0) AS BIGINT) AS boilerplate_words
      FROM w LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN gone USING (r)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, boilerplate_words,
  NOT base_failed AND NOT (n_words - boilerplate_words < {LEAST_WORDS}
    AND 100 * boilerplate_words > {DEPLETED_PERCENT} * n_words) AS kept
FROM b
"""
