"""Stages one by one, and the run as a whole."""

from collections import Counter

import corpus_pipeline as cp
from talkgrain.llm import secret_scan as ss
from tests.llm.frames import edge_docs
from tests.llm.test_ngram_join import plain

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = cp.quality_classifier(spark, docs, FOLDER)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count() and kept.exceptAll(docs).count() == 0

    single = cp.near_copies(spark, docs, FOLDER)
    classes = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, c, _ in classes if i == c)

    leaked = cp.benchmark_leaks(spark, docs, FOLDER)
    items = [r["text"].lower() for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in docs.collect() if not any(i in r["text"].lower() for i in items)}
    assert {r["doc_id"] for r in leaked.collect()} == clean

    bare = {r["doc_id"]: r for r in cp.secrets(spark, docs, FOLDER).collect()}
    for r in docs.collect():
        assert bare[r["doc_id"]]["text"] == ss.redacted(r["text"], ss.all_spans(r["text"], ss.Settings()))
        assert bare[r["doc_id"]]["n_chars"] == len(bare[r["doc_id"]]["text"])
    assert Counter(r["doc_id"] for r in cp.pack(spark, docs, FOLDER).where("piece = 0").collect()) == Counter(list(bare))


def test_edge_cases_go_through(spark):
    docs = edge_docs(spark).select(*cp.COLUMNS, "key", "kept")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() >= 0


def test_run(spark):
    rows = cp.run(spark, FOLDER)
    assert 0 < rows.select("doc_id").distinct().count() < spark.read.parquet(f"{FOLDER}/documents.parquet").count()
