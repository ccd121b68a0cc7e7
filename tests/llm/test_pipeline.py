"""The pipeline's stages, each held against its operator's verdicts on the stage's own input."""

import corpus_pipeline
import duckdb
from conftest import SF001

from adtally.llm import decontam, near_dups, pii, quality
from adtally.llm.common import materialize, table


def _ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_in_order(spark):
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF001), f"test-{name}")
        if name == "quality_rules":
            verdicts = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect()}
            assert _ids(out) == sorted(d for d, kept in verdicts.items() if kept)
        elif name == "near_duplicates":
            classes = {r["doc_id"]: r["class_id"] for r in near_dups.near_duplicate_classes(docs).collect()}
            assert _ids(out) == sorted(set(classes.values()))
        elif name == "decontaminate":
            leaks = {r["doc_id"] for r in decontam.benchmark_leaks(docs, table(spark, SF001, "benchmark")).collect()}
            assert _ids(out) == [d for d in _ids(docs) if d not in leaks]
        elif name == "personal_data":
            assert _ids(out) == _ids(docs)
            for r in out.collect():
                assert pii.base_spans(r["text"])[0] == [] and r["n_chars"] == len(r["text"])
        else:
            assert _ids(out) == _ids(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    assert _ids(corpus_pipeline.run(spark, SF001)) == _ids(docs)


def test_labelled_clean_documents_stay(spark):
    """Documents labelled good of more than the base rule's words are kept by the quality stage."""
    good = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM read_parquet('{SF001}/labels.parquet') WHERE quality = 1").fetchall()}
    rows = quality.quality(table(spark, SF001, "documents")).collect()
    lost = [r["doc_id"] for r in rows if r["doc_id"] in good and not r["base_failed"] and not r["kept"]]
    assert lost == []
