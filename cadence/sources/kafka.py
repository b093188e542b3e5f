"""Log stream source and sink on Kafka.

The Kafka connector is not bundled with PySpark; these functions pass
options through and need ``spark-sql-kafka`` on the classpath. The parsing
step (:func:`parse_logs`) works on any DataFrame with a ``value`` column and
is what the file-based replay and the tests use as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.schemas import LOG_SCHEMA

# A bare NaN token from a pandas producer reaches a string field as this text.
NAN_TEXT = '"NaN"'


def read_log_stream(spark: SparkSession, bootstrap: str, topic: str, starting_offsets: str = "latest",
                    min_partitions: int | None = None, max_offsets_per_trigger: int | None = None,
                    **options: str) -> DataFrame:
    """Subscribe to one topic. ``min_partitions`` splits a one-partition topic over more tasks."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def parse_logs(df: DataFrame, value_col: str = "value", keep_raw: bool = True) -> DataFrame:
    """bytes/text -> typed log record columns (+ ``raw`` text for quarantine).

    Malformed JSON gives an all-null record (PERMISSIVE), which the
    quarantine split then catches by its missing ts.
    """
    raw = F.col(value_col).cast("string")
    parsed = df.select(raw.alias("raw"), F.from_json(raw, LOG_SCHEMA).alias("log"))
    cols = []
    for f in LOG_SCHEMA.fields:
        c = F.col(f"log.{f.name}")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c == F.lit(NAN_TEXT), F.lit(None).cast("string")).otherwise(c)
        cols.append(c.alias(f.name))
    if keep_raw:
        cols.append(F.col("raw"))
    return parsed.select(*cols)


def publish_logs(df: DataFrame, bootstrap: str, topic: str, **options: str) -> None:
    """Write each row as one JSON message (nulls omitted) to the topic."""
    w = (df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
         .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic))
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
