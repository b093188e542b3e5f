"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import chat_format, decontam, knn, langid, merkle, oracles, packing, pii, quality, simhash, suffix_dedup, token_files, vafile, warc
from cadence.llm.common import materialize, table

CONFLICT = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONFLICT).alias("text"))
    out = chat_format.read_chat(materialize(chat_format.format_chat(given.unionByName(extra)), "chat"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_histories(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, payload_bytes, d.payload_digest,
  CASE WHEN first IS NOT NULL AND first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> d.page_id THEN first END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND d.payload_bytes >= 100
"""


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2).drop("row_key")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = knn.whole_vectors(table(spark, sf_dir, "embeddings"))
    return knn.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(
    CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.clustering(vafile.whole_vectors(table(spark, sf_dir, "embeddings")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.without_line_ends(2)).drop("log_position")  # the columns of its SQL


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_chat_format, op2_warc, op3_best_fit_packing, op4_decontamination, op5_quality,
        op6_pii, op7_simhash, op8_token_files, op9_language_id, op10_top_k,
        op11_centroid_clustering, op12_merkle_manifest, op13_suffix_dedup)}


def llm_oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op10_top_k": OP10_SQL,
            "op11_centroid_clustering": oracles.clustering_sql(), "op12_merkle_manifest": oracles.manifest_sql()}
