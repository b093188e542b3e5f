"""Event-time windowed metrics on the enriched stream, with a late-data bound.

The reference stamps each result row with the micro-batch's processing
time. These queries window by the play's own timestamp instead: state is
kept per (window, key) until the watermark passes the window end, then the
final row is emitted once (append mode) and the state is dropped, so state
size is bounded by the watermark delay, not by the stream's length.

The state lies in one partition per core and not in ``spark.sql.shuffle.partitions`` of them
(:func:`state_settings`): each task of a stateful step reports a metric for each state partition, so that what
reaches the driver, and part of the tasks' time, grows with the square of their number.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadence.functions import wallclock_instant
from cadence.operators.enrich import enrich, split_quarantine
from cadence.operators.metrics import (
    salted_engagement,
    salted_leaderboard,
    salted_mood,
    windowed_engagement,
    windowed_leaderboard,
    windowed_mood,
)

KINDS = {"mood": windowed_mood, "leaderboard": windowed_leaderboard, "engagement": windowed_engagement}
SALTED = {"mood": salted_mood, "leaderboard": salted_leaderboard, "engagement": salted_engagement}


EVENT_TIME = "event_time"

#: State partitions for each core of the cluster; the least number of them.
STATE_PER_CORE, LEAST_STATE = 1, 8
#: The state lies on the executors' disks, with a bound on its memory: it holds a row for each open window and key.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}
_STARTING = threading.Lock()


def state_partitions(spark: SparkSession) -> int:
    """Partitions of the state of a windowed job: by the cores that work on it, at most ``spark.sql.shuffle.partitions``."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # a Connect session has no SparkContext
        cores = int(spark.conf.get("spark.default.parallelism", str(most)))
    return min(most, max(LEAST_STATE, STATE_PER_CORE * cores))


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """A streaming query that is started inside keeps its state in :func:`state_partitions` partitions.

    A query copies the session's settings when it starts, and the number of its state partitions stays in its
    checkpoint: a job that goes on from an older one keeps the number it has.
    """
    settings = STATE_CONF | {"spark.sql.shuffle.partitions": str(state_partitions(spark))}
    with _STARTING:
        before = {k: spark.conf.get(k, None) for k in settings}
        try:
            for k, v in settings.items():
                spark.conf.set(k, v)
            yield
        finally:
            for k, v in before.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)


def enriched_stream(logs: DataFrame, store, watermark: str = "10 minutes") -> DataFrame:
    """Stream-static enrichment of the parsed log stream, with an event-time watermark.

    Watermarks need a zoned timestamp, so ``event_time`` is the instant whose
    UTC reading is the play's wall-clock ``timestamp`` (no session zone involved);
    window bounds are mapped back to wall-clock times.
    """
    valid, _ = split_quarantine(logs, raw_col="raw" if "raw" in logs.columns else None)  # see quarantine_stream
    e = enrich(valid, store.tracks, store.artists, store.global_row, artist_broadcast_bytes=-1)
    return e.withColumn(EVENT_TIME, wallclock_instant("timestamp")).withWatermark(EVENT_TIME, watermark)


def quarantine_stream(logs: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """P15 for a windowed job: the rows that :func:`enriched_stream` can't window, with their reason."""
    _, bad = split_quarantine(logs, raw_col="raw" if "raw" in logs.columns else None)
    w = bad.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def windowed_metrics(enriched: DataFrame, kind: str = "mood", size: str = "1 minute", salts: int = 1) -> DataFrame:
    """A4/A5/A6 per event-time tumbling window (needs a watermarked input in streaming).

    With ``salts`` over 1 two stateful aggregations are chained: the first keeps a window's partial sums by
    key and salt, so that the plays of a hot track, or of a window, are spread over the state partitions;
    the second merges the at most ``salts`` rows that the first emits of a key when the watermark closes its
    window. The state of the first grows by up to ``salts`` rows a key.
    """
    return KINDS[kind](enriched, size, EVENT_TIME) if salts <= 1 else SALTED[kind](enriched, size, EVENT_TIME, salts)


class LateRows:
    """Sets aside, batch by batch, the rows that the windowed job of the same input drops as late.

    A batch is held against the watermark that the batches before it left: the latest event time seen so
    far, less the delay, which is what the windowed job knows when the batch starts. A row is late if its
    window has been closed by then. The latest time is kept in a small table, written after the rows
    of its batch, so that a restart goes on with it and a replayed batch replaces its rows.
    """

    def __init__(self, spark, path: str, size: str, delay: str):
        self.spark, self.path, self.size, self.delay = spark, path.rstrip("/"), size, delay

    def watermark(self, batch_id: int) -> int | None:
        """Latest event time of the batches before ``batch_id``, less the delay, in microseconds; None at first."""
        if batch_id == 0:
            return None
        seen = self.spark.read.schema("latest timestamp").parquet(f"{self.path}/latest/batch-{batch_id - 1}")
        return seen.select(F.unix_micros(F.max("latest") - F.expr(f"INTERVAL {self.delay}")).alias("w")).first()["w"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            w = self.watermark(batch_id)
            window = F.window(EVENT_TIME, self.size)
            late = F.lit(False) if w is None else F.coalesce(F.unix_micros(window["end"]) <= w, F.lit(False))
            rows = batch.withColumn("window_start_time", window["start"]).withColumn("late", late)
            rows.where("late").drop("late").write.mode("overwrite").parquet(f"{self.path}/late/batch-{batch_id}")
            latest = batch.agg(F.max(EVENT_TIME).alias("latest"))
            if batch_id > 0:
                before = self.spark.read.schema("latest timestamp").parquet(f"{self.path}/latest/batch-{batch_id - 1}")
                latest = latest.unionByName(before).agg(F.max("latest").alias("latest"))
            latest.write.mode("overwrite").parquet(f"{self.path}/latest/batch-{batch_id}")
        finally:
            batch.unpersist()


def start_late_rows(events: DataFrame, path: str, checkpoint: str, size: str, delay: str, trigger: dict | None = None) -> StreamingQuery:
    """Run :class:`LateRows` on a stream with an ``event_time``, over the same triggers as the windowed job."""
    w = events.writeStream.foreachBatch(LateRows(events.sparkSession, path, size, delay)).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def start_windowed(enriched: DataFrame, path: str, checkpoint: str, kind: str = "mood", size: str = "1 minute",
                   trigger: dict | None = None, fmt: str = "parquet", salts: int = 1) -> StreamingQuery:
    """Append each closed window's row to a Parquet table (exactly once via the file sink log)."""
    w = (windowed_metrics(enriched, kind, size, salts).writeStream.outputMode("append").format(fmt)
         .option("path", path).option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    with state_settings(enriched.sparkSession):
        return w.start()
