"""System metrics from the streaming query's own progress reports.

Spark reports, per micro-batch, the input rate and how long the trigger
took. A listener gathers the reports (one small record per batch, not data) and
writes them as ``system_metrics`` rows, at most ``every`` at a time. Rows are
keyed by query, run and batch, so queries that share a sink don't replace each
other's rows and every report is kept.
"""

from __future__ import annotations

import datetime as dt
import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from cadence.schemas import CONTRACTS


def progress_row(progress) -> dict:
    """One ``system_metrics`` row from a progress report (object or its JSON/dict form)."""
    p = progress
    if hasattr(p, "json"):
        p = json.loads(p.json)
    elif isinstance(p, str):
        p = json.loads(p)
    ts = dt.datetime.strptime(p["timestamp"][:19], "%Y-%m-%dT%H:%M:%S")
    eps = p.get("inputRowsPerSecond") or 0.0
    delay = (p.get("durationMs") or {}).get("triggerExecution", 0)
    return {"timestamp": ts, "events_per_second": int(round(float(eps))),
            "spark_processing_delay_ms": int(delay), "query_id": str(p.get("id", "")), "run_id": str(p.get("runId", "")), "batch_id": int(p.get("batchId", -1)),
            "num_input_rows": int(p.get("numInputRows", 0))}


def progress_metrics(spark: SparkSession, progresses) -> DataFrame:
    """A DataFrame of ``system_metrics`` rows (+ batch_id, num_input_rows)."""
    schema = T.StructType(list(CONTRACTS["system_metrics"]["schema"].fields))
    schema = schema.add("query_id", "string").add("run_id", "string").add("batch_id", "long").add("num_input_rows", "long")
    rows = [progress_row(p) for p in progresses]
    return spark.createDataFrame(rows, schema).where(F.col("num_input_rows") > 0)


class ProgressRecorder(StreamingQueryListener):
    """Writes the progress reports of running queries to a sink, ``every`` reports and when a query ends."""

    def __init__(self, spark: SparkSession, sink, every: int = 100, name: str = "system_metrics"):
        self.spark, self.sink, self.every, self.name = spark, sink, every, name
        self.reports: list[str] = []
        self.batches = 0
        self._lock = threading.Lock()

    def attach(self) -> "ProgressRecorder":
        self.spark.streams.addListener(self)
        return self

    def close(self) -> None:
        """Wait for reports that are still on their way, write the rest and stop listening."""
        self.spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.record(event.progress.json)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self.flush()

    def record(self, report: str) -> None:
        with self._lock:
            self.reports.append(report)
            self.batches += json.loads(report).get("numInputRows", 0) > 0
            full = len(self.reports) >= self.every
        if full:
            self.flush()

    def flush(self) -> int:
        """Write what has been gathered; returns the number of reports."""
        with self._lock:
            reports, self.reports = self.reports, []
        if reports:
            self.sink.write(progress_metrics(self.spark, reports), self.name)
        return len(reports)
