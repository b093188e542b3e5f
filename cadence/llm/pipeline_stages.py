"""Stages of the corpus pipeline: each applies one operator to the documents that came so far.

A stage returns the columns it got (the packing stage: one row per piece). Internal columns carry
the prefix ``_stage_`` so that they don't clash with columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import decontam, packing, pii, quality, simhash
from cadence.llm.common import materialize, row_key, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.5 or more."""
    labels = table(spark, sf_dir, "labels").filter(quality.remainder(3) != 1).select("doc_id", F.col("quality").alias("label"))
    vectors = quality.word_vectors(docs)
    scored = quality.score(docs, vectors, quality.train(docs, labels, vectors))
    return scored.filter(F.col("_stage_quality") >= 0.5).drop("_stage_quality")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays, once.

    Rows equal in doc_id and text are one document. Rows without a doc_id go if their group has a
    named document; of a group without any name all stay.
    """
    groups = materialize(simhash.near_duplicates(docs, simhash.SHINGLE, simhash.RADIUS), "stage-groups")
    first = groups.filter(F.col("doc_id") == F.col("component_id")).groupBy("component_id").agg(F.min("row_key").alias("row_key"))
    stays = first.select("row_key").unionByName(groups.filter("component_id is null").select("row_key")).distinct()
    goes = groups.select("row_key").distinct().join(stays, "row_key", "left_anti").withColumnRenamed("row_key", "_stage_gone")
    kept = docs.withColumn("_stage_key", row_key()).join(goes, F.col("_stage_key") == F.col("_stage_gone"), "left_anti")
    repeats = groups.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").join(stays, "row_key", "left_semi")
    if repeats.limit(1).count():  # only then must the texts be dealt out by key; each task keeps one row of a key before
        kept = kept.dropDuplicates(["_stage_key"])
    return kept.drop("_stage_key")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data masked by kind."""
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places in as few sequences of 4096 ids as can be: one row per piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
