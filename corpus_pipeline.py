"""The corpus pipeline: training documents from the raw table, stage by stage.

Every stage works on all that its predecessor kept and is written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadence.llm import pipeline_stages as stages
from cadence.llm.common import materialize, table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", stages.keep_good),
    ("simhash_near_dedup", stages.keep_one_of_each_group),
    ("benchmark_decontamination", stages.drop_leaks),
    ("pii", stages.mask_personal_data),
    ("best_fit_packing", stages.pack),
]

#: SQL can't express the trained stages; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
