"""Versions of the feature store side by side, and the enriched stream that records which one a batch used.

A stateful query's plan is fixed when it starts, and so are the files of the static side of its joins. The
windowed jobs therefore read their plays from a folder of enriched batches, which :class:`EnrichedBatches` fills by
``foreachBatch``: each micro-batch takes the newest version of the store, and a re-seeded store reaches
the windows without a restart. The plays are enriched once for all windowed jobs.

* A version is written to a folder of its own and listed last (:meth:`VersionedStore.publish`); batches that
  use an older one go on reading it.
* The version of a batch is recorded before the batch is enriched, so that a batch that runs again gives the same rows.
* A batch's rows appear by one rename of their folder; a batch that is there already isn't written again.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cadence.functions import wallclock_instant
from cadence.operators.enrich import enrich, split_quarantine
from cadence.sources.commits import SharedFolder
from cadence.sources.files import TIERS, write_feature_store
from cadence.streaming.job import HOT_TRACK_FRACTION, FeatureStore
from cadence.streaming.windows import EVENT_TIME


class VersionedStore:
    """Feature stores under one root, numbered from 0; ``_versions/<number>.json`` names the folder of each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = SharedFolder(spark, root, "_versions")

    def versions(self) -> list[int]:
        names = [f.getPath().getName() for f in self.files.list(self.files.folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def publish(self, tracks: DataFrame, artists: DataFrame, global_row: DataFrame) -> int:
        """Write the tiers as a new version; its number."""
        folder = f"store-{uuid.uuid4().hex[:12]}"
        write_feature_store(tracks, artists, global_row, os.path.join(self.root, folder))
        number = max(self.versions(), default=-1) + 1
        while not self.files.publish(f"{number}.json", {"folder": folder}):  # another writer was first
            number += 1
        return number

    def tiers(self, version: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        folder = os.path.join(self.root, self.files.read(f"{version}.json")["folder"])
        return tuple(self.spark.read.parquet(os.path.join(folder, t)) for t in TIERS)  # type: ignore[return-value]

    def expire(self, keep_from: int) -> None:
        """Delete the versions before ``keep_from``; a batch that was recorded with one must not run again."""
        for v in self.versions():
            if v < keep_from:
                folder = self.files.read(f"{v}.json")["folder"]
                self.files.delete(os.path.join("_versions", f"{v}.json"))
                self.files.delete(folder)


class EnrichedBatches:
    """``foreachBatch`` handler: enriched plays, with their event time, as ``root``/batch-<id>."""

    def __init__(self, store: VersionedStore, root: str, hot_track_fraction: float | None = HOT_TRACK_FRACTION):
        self.store, self.root, self.hot_track_fraction = store, root.rstrip("/"), hot_track_fraction
        self.files = SharedFolder(store.spark, root, "_chosen")
        self.version: int | None = None
        self.prepared: FeatureStore | None = None

    def version_of(self, batch_id: int) -> int:
        """The version recorded for a batch; the newest one is recorded for a batch that has none."""
        name = f"batch-{batch_id}.json"
        if not self.files.exists("_chosen", name):
            versions = self.store.versions()
            if not versions:
                raise FileNotFoundError(f"no version of the feature store at {self.store.root}")
            self.files.publish(name, {"version": versions[-1]})
        return self.files.read(name)["version"]

    def _tiers(self, version: int) -> FeatureStore:
        if self.prepared is None or version != self.version:
            self.release()
            self.prepared, self.version = FeatureStore.prepare(*self.store.tiers(version)), version
        return self.prepared

    def release(self) -> None:
        if self.prepared is not None:
            self.prepared.release()
            self.prepared = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        target = f"batch-{batch_id}"
        if self.files.exists(target):
            return
        store = self._tiers(self.version_of(batch_id))
        batch = batch.persist()
        try:
            valid, _ = split_quarantine(batch, raw_col="raw" if "raw" in batch.columns else None)
            rows = enrich(valid, store.tracks, store.artists, store.global_row, artist_broadcast_bytes=-1,
                          hot_track_fraction=self.hot_track_fraction)
            trial = os.path.join(self.root, f"_trial-{uuid.uuid4().hex[:12]}")
            rows.withColumn(EVENT_TIME, wallclock_instant("timestamp")).write.parquet(trial)
            self.files.move(trial, os.path.join(self.root, target))
        finally:
            batch.unpersist()


def start_enriched(logs: DataFrame, handler: EnrichedBatches, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Enrich every micro-batch of the parsed log stream with the newest version of the store."""
    w = logs.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def enriched_batches(spark: SparkSession, root: str, schema, watermark: str = "10 minutes") -> DataFrame:
    """The stream of the plays that :class:`EnrichedBatches` wrote to ``root``, for windowed jobs."""
    return spark.readStream.schema(schema).parquet(os.path.join(root.rstrip("/"), "batch-*")).withWatermark(EVENT_TIME, watermark)
