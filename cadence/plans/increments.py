"""Incremental refresh of the dimension tables (D1-D3): partial states per committed batch, merged on demand.

A batch's plays are read once, when the batch is first seen, and kept as sums and earliest times per track, names
and year. The dimensions are merged from these states, which are as large as the catalog and not as the history.

The states have a commit log of their own under the events' root. A state version lists one folder for each batch that
may still be replaced, named after the events folder that it was made from, and base folders of the others; and the version of the events tables that it stands for. An advance

* makes states of new batches, and anew of batches that were committed again (sums could be taken back, but
  not earliest times);
* follows the commits since its last version, so that it knows which try of a batch went into merged days. Where
  those commits have expired, merged batches without a state, or with one that can't be told to be the last
  try's, are read from the days, all in one pass;
* merges the states of batches that the events tables have merged, which nobody can replace, into the base, once
  there are more than ``MERGE_AT`` folders of them;
* publishes all of it in one commit. A broken advance leaves folders that no version lists, and the next one repeats it.

Defined cases: no committed batch gives empty states; a batch without plays has an empty folder; null names and
tracks are groups of their own, which the dimensions leave out as the full refresh does.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.operators.profiles import STATE_SCHEMA, merge_states, play_states
from cadence.plans.refresh import refresh_from_states
from cadence.sources.commits import BATCH, MERGED, CommitLog, CommittedSink, Folder, Snapshot

EVENTS = "realtime_streaming_events"
STATES, APPLIED = "play_states", "applied"
#: Most folders of the base and of settled batches; more are merged into one.
MERGE_AT = 16
#: Stands for the try of a merged batch whose commits have expired.
UNKNOWN = "merged"


class IncrementalDimensions:
    """The partial states of ``sink``'s events table, kept under its root."""

    def __init__(self, sink: CommittedSink, merge_at: int = MERGE_AT):
        self.sink, self.merge_at = sink, merge_at
        self.root = os.path.join(sink.root.rstrip("/"), "_dimension_states")

    def _log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, self.root)

    def _tries(self, spark: SparkSession, states: Snapshot, now: Snapshot) -> dict[int, str]:
        """Batch -> name of the events folder that holds, or for merged batches last held, its rows."""
        applied = next((f.batch_id for f in states.of(APPLIED)), -1)
        last = {f.batch_id: _made_from(f) for f in states.of(STATES) if f.kind == BATCH}
        source = CommitLog(spark, self.sink.root)
        changes, _ = source.versions()
        if all(v in changes for v in range(applied + 1, now.version + 1)):
            for v in range(applied + 1, now.version + 1):
                last.update({f.batch_id: os.path.basename(f.path) for f in map(Folder.of, source.read(changes[v])["add"])
                             if f.table == EVENTS and f.kind == BATCH})
        else:
            last = {b: UNKNOWN for b in now.merged_batches}
        out = {b: last.get(b, UNKNOWN) for b in now.merged_batches}
        out.update({f.batch_id: os.path.basename(f.path) for f in now.of(EVENTS) if f.kind == BATCH})
        return out

    def advance(self, spark: SparkSession) -> list[int]:
        """Bring the states up to the newest commit; the batches whose plays were read for it."""
        log, source = self._log(spark), CommitLog(spark, self.sink.root)
        states, now = log.snapshot(), source.snapshot()
        tries = self._tries(spark, states, now)
        held = {f.batch_id: f for f in states.of(STATES) if f.kind == BATCH}
        base = [f for f in states.of(STATES) if f.kind == MERGED]
        todo = sorted(b for b, name in tries.items()
                      if b not in states.merged_batches and (b not in held or _made_from(held[b]) != name))
        marks = states.of(APPLIED)
        if not todo and marks and marks[0].batch_id == now.version:
            return []
        add, remove = [Folder(APPLIED, f"version-{now.version}", APPLIED, now.version)], [f for f in marks if f.batch_id != now.version]
        folders = {f.batch_id: f for f in now.of(EVENTS) if f.kind == BATCH}
        held = {b: f for b, f in held.items() if b in tries and b not in todo}
        for b in [b for b in todo if b in folders]:
            rows = self.sink.read_folders(spark, EVENTS, [folders[b]])
            held[b] = Folder(STATES, self._write(play_states(rows), tries[b]), BATCH, b)
        merged = [b for b in todo if b not in folders]
        if merged:  # in one pass over the days, for the base: nobody can replace them
            rows = self.sink.read_folders(spark, EVENTS, [f for f in now.of(EVENTS) if f.kind == MERGED])
            base.append(Folder(STATES, self._write(play_states(rows.where(F.col("batch_id").isin(merged))), "base"), MERGED))
        settled = [f for b, f in sorted(held.items()) if b in now.merged_batches]
        if len(settled) + len(base) > self.merge_at:
            merged += [f.batch_id for f in settled]
            base, held = ([Folder(STATES, self._write(merge_states(self._read(spark, [*base, *settled])), "base"), MERGED)],
                          {b: f for b, f in held.items() if f not in settled})
        want = {*base, *held.values()}
        add += [f for f in want if f not in states.folders]
        remove += [f for f in states.of(STATES) if f not in want]

        def plan(newer: Snapshot):
            if newer.version != states.version:
                raise RuntimeError("another refresh came first")
            return add, remove, merged

        log.commit(plan)
        return todo

    def _write(self, states: DataFrame, name: str) -> str:
        path = os.path.join(STATES, f"{name}--{uuid.uuid4().hex[:12]}")
        states.write.parquet(os.path.join(self.root, path))
        return path

    def _read(self, spark: SparkSession, folders: list[Folder]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], STATE_SCHEMA)
        return spark.read.schema(STATE_SCHEMA).parquet(*[os.path.join(self.root, f.path) for f in folders])

    def states(self, spark: SparkSession) -> DataFrame:
        """The partial states of all plays up to the last advance."""
        return self._read(spark, self._log(spark).snapshot().of(STATES))

    def refresh(self, spark: SparkSession, clean_catalog: DataFrame) -> dict[str, DataFrame]:
        """Advance and write the four dimension tables."""
        self.advance(spark)
        return refresh_from_states(self.sink, self.states(spark), clean_catalog)

    def expire(self, spark: SparkSession) -> int:
        """Delete the state folders that the newest version doesn't list; returns how many."""
        log = self._log(spark)
        live = {os.path.basename(f.path) for f in log.snapshot().of(STATES)}
        gone = [f.getPath().getName() for f in log.list(self.root, STATES) if f.getPath().getName() not in live]
        for name in gone:
            log.delete(os.path.join(STATES, name))
        return len(gone)


def _made_from(state: Folder) -> str:
    return os.path.basename(state.path).split("--")[0]
