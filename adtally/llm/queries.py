"""The thin registered queries over the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import alignment, bpe, class_lm, decontam, html_text, merkle, near_dups, pii, quality, repeats, secrets, token_files, url_filter
from adtally.llm.common import table

#: The rules of op5.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: A host is blocked if one of its labels has one of these words.
BLOCKED_WORDS = ("bets", "casino", "pills", "porn", "spam", "xxx")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("fp")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_checksums(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicate_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def blocked_hosts(pages: DataFrame) -> DataFrame:
    """Hosts of ``pages`` of which a hyphenated part is a blocked word."""
    hosts = url_filter.with_host_and_path(pages.select("url")).select("host").distinct()
    return hosts.where(F.arrays_overlap(F.split("host", "[.-]"), F.array(*map(F.lit, BLOCKED_WORDS)))).select(F.col("host").alias("entry"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, URL_RULES, blocked_hosts(pages))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op13_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_documents(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_secrets, op2_decontaminate, op3_token_files, op4_near_duplicates, op5_url_filter, op6_bpe, op7_html_text, op8_quality, op9_pii, op10_repeats, op11_alignment, op12_merkle, op13_class_lm)
    return {f.__name__: f for f in named}


def _url_oracle() -> str:
    fits = " UNION ALL ".join(f"SELECT '{text.split('/', 1)[0]}' AS rh, '/{text.split('/', 1)[1]}' AS rp, '{text}' AS rule, '{said}' AS said" for text, said in URL_RULES)
    words = ", ".join(f"'{w}'" for w in BLOCKED_WORDS)
    return f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') END AS rest FROM pages),
h AS (SELECT r, page_id, coalesce(translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM p),
rules AS ({fits}),
fit AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said FROM h JOIN rules
  ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r),
bad AS (SELECT DISTINCT host FROM h WHERE len(list_filter(regexp_split_to_array(host, '[.-]'), lambda x: x IN ({words}))) > 0)
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN EXISTS (SELECT 1 FROM bad WHERE h.host = bad.host OR ends_with(h.host, '.' || bad.host)) THEN 'block' ELSE 'allow' END) AS verdict,
  (SELECT arg_max(bad.host, length(bad.host)) FROM bad WHERE h.host = bad.host OR ends_with(h.host, '.' || bad.host)) AS listed
FROM h LEFT JOIN fit USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_secrets": secrets.ORACLE, "op5_url_filter": _url_oracle(), "op8_quality": quality.ORACLE, "op12_merkle": merkle.ORACLE}
