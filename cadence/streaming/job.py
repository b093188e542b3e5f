"""The streaming job (S10, W1-W3, W5, W6): log stream -> enrichment -> five result tables.

``readStream -> parse -> foreachBatch { persist -> quarantine split ->
enrich (stream-static joins) -> five aggregates -> idempotent writes }``.

Scale notes:

* The static feature tiers are prepared once per query, not per batch: the
  track tier is hash-partitioned on its id and persisted, so every
  micro-batch shuffles only its own rows to meet it (the catalog is never
  re-shuffled); the artist tier is measured once and broadcast only when
  small; the global tier is one row.
* The sinks replace a batch's rows of every table as a whole: a batch
  replayed after a failure, on whatever day, doesn't add them again. Progress
  lives in the checkpoint folder, so a restart continues from the last
  committed batch. With a :class:`CommittedSink` the tables of a batch appear
  together: a reader never sees a batch that was stopped between two writes.
* The enriched batch is persisted (memory and disk): the events table is
  written first and fills the cache, then the other writes run as concurrent
  jobs over it. Lost blocks are recomputed from the source offsets.
* A feature store that is written again while the stream runs is read again
  before the next batch (:class:`WatchedStore`).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadence.operators.enrich import enrich, split_quarantine
from cadence.operators.metrics import engagement, leaderboard, mood_metrics, mood_sample
from cadence.operators.sizing import broadcast_if_small
from cadence.sources.commits import CommittedSink
from cadence.sources.files import load_feature_store, store_version
from cadence.sources.sinks import conform, split_violations, violation


@dataclass
class FeatureStore:
    tracks: DataFrame
    artists: DataFrame
    global_row: DataFrame

    @classmethod
    def prepare(cls, tracks: DataFrame, artists: DataFrame, global_row: DataFrame,
                track_partitions: int | None = None, max_broadcast_bytes: int | None = None) -> FeatureStore:
        """Lay the static tiers out once for many micro-batches (see module notes)."""
        spark = tracks.sparkSession
        n = track_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        t = tracks.repartition(n, "id").persist(StorageLevel.MEMORY_AND_DISK)
        a = broadcast_if_small(artists, max_broadcast_bytes).persist(StorageLevel.MEMORY_AND_DISK)
        g = global_row.persist(StorageLevel.MEMORY_AND_DISK)
        return cls(t, a, g)

    def release(self) -> None:
        for df in (self.tracks, self.artists, self.global_row):
            df.unpersist()


class WatchedStore:
    """The feature store under ``path``, prepared again when it has been written again."""

    def __init__(self, spark: SparkSession, path: str, catalog: DataFrame | None = None):
        self.spark, self.path, self.catalog = spark, path, catalog
        self.store: FeatureStore | None = None
        self.version = ""

    def current(self) -> FeatureStore:
        version = store_version(self.spark, self.path)
        if self.store is None or version != self.version:
            self.release()
            self.store = FeatureStore.prepare(*load_feature_store(self.spark, self.path, catalog=self.catalog))
            self.version = store_version(self.spark, self.path)  # it may just have been built
        return self.store

    def release(self) -> None:
        if self.store is not None:
            self.store.release()
            self.store = None


def batch_stamp(spark: SparkSession, when: dt.datetime | None = None):
    """One wall-clock literal per batch, shared by all tables.

    Spark's own clock in the session zone, the one that lookbacks are anchored to.
    """
    if when is not None:
        text = when.strftime("%Y-%m-%d %H:%M:%S")
    else:
        text = spark.sql("SELECT substring(CAST(localtimestamp() AS STRING), 1, 19)").first()[0]
    return F.lit(text).cast("timestamp_ntz")


def _write_all(sink, tables: list[tuple[DataFrame, str]], batch_id: int, parallel: bool) -> None:
    """Write each (frame, table): the first fills the cache, the others then run as concurrent Spark jobs."""
    first, rest = tables[0], tables[1:]
    sink.write(*first, batch_id)
    if not parallel or len(rest) < 2:
        for df, name in rest:
            sink.write(df, name, batch_id)
        return
    with ThreadPoolExecutor(max_workers=len(rest)) as pool:
        futures = [pool.submit(sink.write, df, name, batch_id) for df, name in rest]
        for f in futures:
            f.result()


HOT_TRACK_FRACTION = 0.01


def process_batch(batch: DataFrame, batch_id: int, store: FeatureStore | WatchedStore, sink, *,
                  sample_n: int = 200, sample_mode: str = "limit", when: dt.datetime | None = None,
                  parallel_writes: bool = True, hot_track_fraction: float | None = HOT_TRACK_FRACTION) -> bool:
    """One micro-batch -> events, leaderboard, mood, engagement, samples (+ quarantine).

    Returns False for an empty batch (nothing written, P13). The writes read
    the same persisted enriched batch; each replaces the batch's rows, so a
    failure in one is repaired by the batch's retry without duplicating the
    others. Tracks with ``hot_track_fraction`` of the plays are joined
    map-side, since AQE cannot split skew against the persisted track tier.
    Event rows that break a NOT NULL or a length rule go to the quarantine table, and to no other.
    """
    if isinstance(store, WatchedStore):
        store = store.current()
    spark = batch.sparkSession
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = batch.count()                      # also fills the cache
        if rows == 0:
            return False
        raw_col = "raw" if "raw" in batch.columns else None
        valid, bad = split_quarantine(batch, raw_col=raw_col)
        enriched = enrich(valid, store.tracks, store.artists, store.global_row, artist_broadcast_bytes=-1,
                          hot_track_fraction=hot_track_fraction, log_rows=rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stamp = batch_stamp(spark, when)
            ok, broken = split_violations(enriched, "realtime_streaming_events")
            broken = broken.select(F.to_json(F.struct("*")).alias("raw"), violation("realtime_streaming_events", broken.columns).alias("reason"))
            tables = [
                (conform(ok, "realtime_streaming_events"), "realtime_streaming_events"),
                (conform(leaderboard(ok, stamp), "realtime_leaderboard"), "realtime_leaderboard"),
                (conform(mood_metrics(ok, stamp), "realtime_mood_metrics"), "realtime_mood_metrics"),
                (conform(engagement(ok, stamp), "engagement_metrics"), "engagement_metrics"),
                (conform(mood_sample(ok, sample_n, sample_mode), "mood_matrix_samples"), "mood_matrix_samples"),
                (conform(bad, "quarantine").unionByName(broken), "quarantine"),
            ]
            _write_all(sink, tables, batch_id, parallel_writes)
            if isinstance(sink, CommittedSink):  # only now is the batch seen, in all tables at once
                sink.commit(spark, batch_id)
        except BaseException:
            if isinstance(sink, CommittedSink):
                sink.abandon(batch_id)
            raise
        finally:
            enriched.unpersist()
        return True
    finally:
        batch.unpersist()


def start_stream_job(logs: DataFrame, store: FeatureStore | WatchedStore, sink, checkpoint: str,
                     trigger: dict | None = None, query_name: str | None = None, **batch_options) -> StreamingQuery:
    """Run :func:`process_batch` on every micro-batch of the parsed log stream.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default: as soon
    as possible); ``availableNow=True`` processes what is there and stops.
    """
    def handle(batch_df: DataFrame, batch_id: int) -> None:
        process_batch(batch_df, batch_id, store, sink, **batch_options)

    w = logs.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


__all__ = ["FeatureStore", "WatchedStore", "process_batch", "start_stream_job", "batch_stamp"]
