"""S3: a listening history as a live log stream.

The reference's producer loops over a file on one machine and sleeps between
messages. Here a folder of JSON-line files is read as a file stream: the rate
is set by ``maxFilesPerTrigger`` and the trigger interval instead of a sleep,
and the same files can be replayed to test recovery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadence.functions import to_json_row
from cadence.schemas import LOG_SCHEMA
from cadence.sources.kafka import parse_logs


def log_lines(history: DataFrame) -> DataFrame:
    """The messages of the log topic: each cleaned play as one JSON text ``value``, in ranges of ts.

    One range-partitioned job lays a history of any size out as files; plays
    without a ts come first, so none is lost.
    """
    cols = [f.name for f in LOG_SCHEMA.fields]
    return history.select(*cols).repartitionByRange("ts").select(to_json_row(*cols).alias("value"))


def replay_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parsed log stream from JSON-line files (S2 applied to each line, raw text kept)."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return parse_logs(reader.text(path), "value")
