"""The corpus pipeline: every stage on its own input, and what each keeps."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from cadence.llm import decontam, pii, pipeline_stages, simhash
from cadence.llm.common import materialize, table

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


def test_stage_order_and_columns(spark):
    docs = table(spark, SF, "documents")
    names, columns, sizes = [], docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        names.append(name)
        sizes.append(docs.count())
        if name != "best_fit_packing":
            assert docs.columns == columns
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]
    assert 200 >= sizes[0] >= sizes[1] >= sizes[2] == sizes[3] > 100
    rows = docs.collect()
    assert len({r["doc_id"] for r in rows}) == sizes[3]


def test_one_document_of_each_group_stays(spark):
    docs = table(spark, SF, "documents").withColumn("row_key", F.col("lang"))
    extra = docs.limit(3).unionByName(docs.limit(1))  # repeated rows
    docs = materialize(docs.unionByName(extra), "test-docs")
    kept = STAGE["simhash_near_dedup"](spark, docs, SF)
    ids = [r["doc_id"] for r in kept.collect()]
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert kept.columns == docs.columns and Counter(ids) == Counter(set(groups.values()))


def test_nameless_documents(spark):
    rows = [(None, "one nameless text that nobody repeats"), (None, "a text with a name in its group"), (4, "a text with a name in its group"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = pipeline_stages.keep_one_of_each_group(spark, docs, SF).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("None", rows[0][1]), ("4", rows[2][1]), ("5", None)], key=lambda x: (x[0], str(x[1])))


def test_leaks_go_and_data_is_masked(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    leaked = {r["doc_id"] for r in decontam.leaks(docs, items).collect()}
    kept = {r["doc_id"] for r in STAGE["benchmark_decontamination"](spark, docs, SF).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - leaked and leaked
    masked = {r["doc_id"]: r["text"] for r in STAGE["pii"](spark, docs, SF).collect()}
    for r in docs.collect():
        assert masked[r["doc_id"]] == pii.masked(r["text"], pii.base_spans(r["text"]))


def test_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        assert docs.count() == 0
