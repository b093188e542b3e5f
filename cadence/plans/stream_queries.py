"""Registered queries over streamed result tables: the stream run over a test-data folder.

The cleaned history is laid out as JSON-line files and streamed through the
job and through the windowed jobs once per application; every query reads
the tables that the run wrote and must equal the batch result.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions import instant_wallclock, present, wallclock_instant
from cadence.operators import profiles
from cadence.operators.enrich import split_quarantine
from cadence.plans.dashboard import as_doubles, dashboard
from cadence.plans.increments import IncrementalDimensions
from cadence.plans.oracle import ENRICHED_SELECT, PRELUDE, batch_oracle, p6
from cadence.plans.registry import show
from cadence.plans.workload import Workload
from cadence.schemas import BATCH_TABLES, ENRICHED_COLUMNS, ENRICHED_SCHEMA, LOG_SCHEMA
from cadence.session import app_id, run_folder
from cadence.sources.commits import CommittedSink
from cadence.sources.files import load_feature_store
from cadence.sources.kafka import parse_logs
from cadence.sources.sinks import LONG_REASON, TableSink
from cadence.streaming.job import FeatureStore, process_batch, start_stream_job
from cadence.streaming.progress import ProgressRecorder
from cadence.streaming.repeats import drop_repeats
from cadence.streaming.replay import log_lines, replay_stream
from cadence.streaming.versions import EnrichedBatches, VersionedStore, enriched_batches, start_enriched
from cadence.streaming.windows import EVENT_TIME, KINDS, enriched_stream, start_late_rows, start_windowed

STREAM_WINDOW = "10 minutes"
STREAM_WATERMARK = "1 hour"
#: Micro-batches of the run, about: files are dealt to so many triggers.
BATCHES = 4
#: Keys that a window's plays are dealt over in the salted windowed jobs.
SALTS = 8

_RUNS: dict[tuple[str, str, str], str] = {}


def _input_files(spark: SparkSession, path: str) -> int:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path").count()


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")


def _root(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    """The folder of one kind of run over ``sf_dir``, built by the first query that needs it."""
    key = (app_id(spark), sf_dir, kind)
    if key not in _RUNS:
        root = run_folder(spark, f"stream-{kind}")
        build(spark, sf_dir, root)
        _RUNS[key] = root
    return _RUNS[key]


def _store(spark: SparkSession, sf_dir: str, root: str) -> FeatureStore:
    w = Workload.of(spark, sf_dir)
    return FeatureStore.prepare(*load_feature_store(spark, os.path.join(root, "store"), catalog=w.catalog))


def _laid_out(plays: DataFrame, key: str, path: str) -> DataFrame:
    """``plays`` written once in folders by ``key``, so that a run over several batches derives the history only once."""
    plays.hint("rebalance", F.col(key)).write.partitionBy(key).parquet(path)
    return plays.sparkSession.read.schema(plays.schema).parquet(path)


def _build_job(spark: SparkSession, sf_dir: str, root: str) -> None:
    inp = os.path.join(root, "input")
    log_lines(Workload.of(spark, sf_dir).history).write.text(inp)
    store, sink = _store(spark, sf_dir, root), CommittedSink(os.path.join(root, "tables"))
    recorder = ProgressRecorder(spark, sink).attach()
    try:
        per_batch = -(-max(1, _input_files(spark, inp)) // BATCHES)
        _run(start_stream_job(replay_stream(spark, inp, per_batch), store, sink, os.path.join(root, "_checkpoint"), trigger={"availableNow": True}))
    finally:
        recorder.close()
        store.release()


def _build_windows(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Event-time windows with a watermark, one stateful query per kind over the same files.

    All files are one batch: nothing is late, and the windows that the final watermark passes are emitted.
    """
    inp = os.path.join(root, "input")
    log_lines(Workload.of(spark, sf_dir).history).write.text(inp)
    store = _store(spark, sf_dir, root)
    try:
        running = [start_windowed(enriched_stream(replay_stream(spark, inp), store, STREAM_WATERMARK), os.path.join(root, kind),
                                  os.path.join(root, f"_checkpoint_{kind}"), kind=kind, size=STREAM_WINDOW, trigger={"availableNow": True})
                   for kind in KINDS]
        for q in running:
            _run(q)
    finally:
        store.release()


def _build_replayed(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The whole history as one batch, processed on one day and again, after a failure, on the next."""
    logs = parse_logs(log_lines(Workload.of(spark, sf_dir).history), "value")
    store, sink = _store(spark, sf_dir, root), TableSink(os.path.join(root, "tables"))
    try:
        for day in (1, 2):
            process_batch(logs, 0, store, sink, when=dt.datetime(2024, 3, day, 23, 59, 59))
    finally:
        store.release()


#: Plays whose track name is made too long for the result tables, by event id.
LONG_NAME = 41


def _build_long(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The whole history as one batch; every 41st play has a name of over 255 characters."""
    name = F.when(F.col("event_id") % LONG_NAME == 0, F.rpad("track_name", 256, "~")).otherwise(F.col("track_name"))
    logs = parse_logs(log_lines(Workload.of(spark, sf_dir).history.withColumn("track_name", name)), "value")
    store = _store(spark, sf_dir, root)
    try:
        process_batch(logs, 0, store, CommittedSink(os.path.join(root, "tables")), when=dt.datetime(2024, 3, 1))
    finally:
        store.release()


class _Stopped(RuntimeError):
    pass


class _StoppingSink(CommittedSink):
    """Breaks off batch ``stop_at`` at its engagement table, when other tables have been written."""

    stop_at = 3

    def write(self, df: DataFrame, name: str, batch_id: int | None = None) -> None:
        if batch_id == self.stop_at and name == "engagement_metrics":
            raise _Stopped(name)
        super().write(df, name, batch_id)


def _build_stopped(spark: SparkSession, sf_dir: str, root: str) -> None:
    """A batch for each quarter of the day; the last is stopped between two writes, the others are merged into days."""
    history = Workload.of(spark, sf_dir).history.withColumn("_quarter", F.floor(F.hour("ts") / 6))
    history = _laid_out(history, "_quarter", os.path.join(root, "history"))
    store, sink = _store(spark, sf_dir, root), _StoppingSink(os.path.join(root, "tables"))
    try:
        for k in range(4):
            logs = parse_logs(log_lines(history.where(F.col("_quarter") == k)), "value")
            try:
                process_batch(logs, k, store, sink, when=dt.datetime(2024, 3, 1, 6 * k))
            except _Stopped:
                pass
        sink.compact(spark, [*BATCH_TABLES, "quarantine"])
        sink.expire(spark)
    finally:
        store.release()


def _quarters(history: DataFrame) -> DataFrame:
    """The plays with a ts, and the quarter (``_quarter``, from 0) of their time span."""
    second = F.unix_seconds(wallclock_instant("ts"))
    history = history.where("ts is not null").withColumn("_s", second)
    first, last = history.agg(F.min("_s"), F.max("_s")).first()
    return history.withColumn("_quarter", F.floor((F.col("_s") - (first or 0)) * 4 / ((last or 0) - (first or 0) + 1)))


def _build_late(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The plays in quarters of their time span, one trigger each; plays of every fifth second come a quarter late."""
    w = Workload.of(spark, sf_dir)
    history = _quarters(w.history)
    history = history.withColumn("_arrival", F.col("_quarter") + F.when(F.col("_s") % 5 == 0, 1).otherwise(0))
    history = _laid_out(history, "_arrival", os.path.join(root, "history"))
    store, inp, now = _store(spark, sf_dir, root), os.path.join(root, "input"), {"availableNow": True}
    try:
        for k in range(5):
            log_lines(history.where(F.col("_arrival") == k)).write.mode("append").text(inp)
            for q in (start_windowed(enriched_stream(replay_stream(spark, inp), store, STREAM_WATERMARK), os.path.join(root, "windows"),
                                     os.path.join(root, "_checkpoint_windows"), kind="mood", size=STREAM_WINDOW, trigger=now),
                      start_late_rows(enriched_stream(replay_stream(spark, inp), store, STREAM_WATERMARK), os.path.join(root, "aside"),
                                      os.path.join(root, "_checkpoint_aside"), STREAM_WINDOW, STREAM_WATERMARK, trigger=now)):
                _run(q)
    finally:
        store.release()


def _build_increments(spark: SparkSession, sf_dir: str, root: str) -> None:
    """A batch for each quarter of the time span, with an advance of the dimensions' states after each.

    The second batch is committed with half of its plays, and after an advance again with all; then batches are merged into days.
    """
    history = _laid_out(_quarters(Workload.of(spark, sf_dir).history), "_quarter", os.path.join(root, "history"))
    store, sink = _store(spark, sf_dir, root), CommittedSink(os.path.join(root, "tables"))
    dimensions = IncrementalDimensions(sink, merge_at=2)

    def batch(k: int, plays: DataFrame) -> None:
        process_batch(parse_logs(log_lines(plays), "value"), k, store, sink, when=dt.datetime(2024, 3, 1, k))
        dimensions.advance(spark)

    try:
        for k in range(4):
            plays = history.where(F.col("_quarter") == k)
            if k == 1:
                batch(k, plays.where("_s % 2 = 0"))
            if k == 3:
                sink.compact(spark, [*BATCH_TABLES, "quarantine"])
            batch(k, plays)
        dimensions.expire(spark)
    finally:
        store.release()


def _build_reseeded(spark: SparkSession, sf_dir: str, root: str) -> None:
    """A trigger for each quarter; after two, a store with half the valence and energy is published.

    The windowed jobs, salted, read the enriched batches.
    """
    w = Workload.of(spark, sf_dir)
    history = _laid_out(_quarters(w.history), "_quarter", os.path.join(root, "history"))
    inp, now = os.path.join(root, "input"), {"availableNow": True}
    store = VersionedStore(spark, os.path.join(root, "store"))
    store.publish(w.tracks, w.artists, w.global_row)
    handler, schema = EnrichedBatches(store, os.path.join(root, "enriched")), T.StructType([*ENRICHED_SCHEMA.fields]).add(EVENT_TIME, "timestamp")
    try:
        for k in range(4):
            if k == 2:
                half = {c: F.col(c) / 2 for c in ("valence", "energy")}
                store.publish(*(t.withColumns(half) for t in (w.tracks, w.artists, w.global_row)))
            log_lines(history.where(F.col("_quarter") == k)).write.mode("append").text(inp)
            _run(start_enriched(replay_stream(spark, inp), handler, os.path.join(root, "_checkpoint"), trigger=now))
            running = [start_windowed(enriched_batches(spark, handler.root, schema, STREAM_WATERMARK), os.path.join(root, kind),
                                      os.path.join(root, f"_checkpoint_{kind}"), kind=kind, size=STREAM_WINDOW, trigger=now, salts=SALTS)
                       for kind in KINDS]
            for q in running:
                _run(q)
    finally:
        handler.release()


def _build_repeated(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Every message of the history; those of every third second are sent again, in a later trigger of their own."""
    w = Workload.of(spark, sf_dir)
    inp, store, sink = os.path.join(root, "input"), _store(spark, sf_dir, root), CommittedSink(os.path.join(root, "tables"))
    again = w.history.where(F.unix_seconds(wallclock_instant("ts")) % 3 == 0)
    try:
        for lines in (w.history, again):
            log_lines(lines).write.mode("append").text(inp)
            _run(start_stream_job(drop_repeats(replay_stream(spark, inp), "1 day"), store, sink, os.path.join(root, "_checkpoint"),
                                  trigger={"availableNow": True}))
    finally:
        store.release()


def _sink(spark: SparkSession, sf_dir: str, kind: str = "job") -> TableSink:
    build = {"job": _build_job, "replayed": _build_replayed, "stopped": _build_stopped, "repeated": _build_repeated, "long": _build_long,
             "increments": _build_increments}[kind]
    path = os.path.join(_root(spark, sf_dir, kind, build), "tables")
    return TableSink(path) if kind == "replayed" else CommittedSink(path)


def _windows(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return spark.read.parquet(os.path.join(_root(spark, sf_dir, "windows", _build_windows), kind))


def _counts(sink: TableSink, spark: SparkSession) -> DataFrame:
    lb = sink.read(spark, "realtime_leaderboard")
    return lb.groupBy("track_uri").agg(F.sum("play_count").cast("long").alias("plays"))


def stream_play_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream = batch: per-batch leaderboard counts summed per track equal the batch count."""
    return _counts(_sink(spark, sf_dir), spark)


def stream_replayed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch processed twice, on two days, counts once in every table."""
    sink = _sink(spark, sf_dir, "replayed")
    plays = _counts(sink, spark)
    ends = sink.read(spark, "engagement_metrics").groupBy("track_uri").agg(
        F.sum("skip_count").cast("long").alias("skip_count"), F.sum("natural_end_count").cast("long").alias("natural_end_count"))
    events = sink.read(spark, "realtime_streaming_events").groupBy("track_uri").agg(F.count(F.lit(1)).alias("events"))
    return plays.join(ends, "track_uri").join(events, "track_uri")


def stream_committed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a batch that was stopped between two writes no table shows anything, of the others every table shows all."""
    sink = _sink(spark, sf_dir, "stopped")
    plays = _counts(sink, spark)
    ends = sink.read(spark, "engagement_metrics").groupBy("track_uri").agg(
        F.sum("skip_count").cast("long").alias("skip_count"), F.sum("natural_end_count").cast("long").alias("natural_end_count"))
    events = sink.read(spark, "realtime_streaming_events").groupBy("track_uri").agg(F.count(F.lit(1)).alias("events"))
    return plays.join(ends, "track_uri", "full").join(events, "track_uri", "full")


def stream_compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the committed events, after their batches were merged into days."""
    sink = _sink(spark, sf_dir, "stopped")
    return as_doubles(sink.read(spark, "realtime_streaming_events")).select(F.col("batch_id").cast("int").alias("batch_id"), *ENRICHED_COLUMNS)


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IncrementalDimensions(_sink(spark, sf_dir, "increments")).states(spark)


def stream_incremental_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 merged from the partial states of four batches, one of them replaced and some merged into days."""
    return show(profiles.artists_of_states(_states(spark, sf_dir), Workload.of(spark, sf_dir).clean_catalog))


def stream_incremental_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 merged from the same partial states."""
    return show(profiles.tracks_of_states(_states(spark, sf_dir), Workload.of(spark, sf_dir).clean_catalog))


def stream_incremental_albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 merged from the same partial states."""
    return show(profiles.albums_of_states(_states(spark, sf_dir)))


def stream_late_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 over several triggers: plays in time of every closed window, and those that came after it had closed."""
    root = _root(spark, sf_dir, "late", _build_late)
    schema = T.StructType().add("window_start_time", "timestamp")
    late = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(os.path.join(root, "aside", "late"))
    late = late.groupBy(instant_wallclock("window_start_time").alias("window_start_time")).agg(F.count(F.lit(1)).alias("late"))
    on_time = spark.read.parquet(os.path.join(root, "windows")).select("window_start_time", F.col("total_streams").alias("on_time"))
    both = on_time.join(late, "window_start_time", "full")
    return both.select("window_start_time", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("on_time", "late")])


def _reseeded(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return spark.read.parquet(os.path.join(_root(spark, sf_dir, "reseeded", _build_reseeded), kind))


def stream_reseeded_mood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mood of every closed window, from a windowed job whose feature store is published anew half-way."""
    return show(_reseeded(spark, sf_dir, "mood").select(
        "window_start_time", "window_end_time", "avg_valence", "avg_energy", "total_streams", "sum_valence", "sum_energy"))


def stream_salted_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays per track of every closed window, in two chained aggregations over several triggers."""
    return _reseeded(spark, sf_dir, "leaderboard").select(
        "window_start_time", "window_end_time", "track_uri", "track_name", "artist_name", "play_count")


def stream_salted_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement per track of every closed window, in two chained aggregations over several triggers."""
    return show(_reseeded(spark, sf_dir, "engagement").select(
        "window_start_time", "window_end_time", "track_uri", "completion_rate", "skip_count", "natural_end_count"))


def stream_deduplicated_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays and skips per track of a log in which a third of the messages stand twice."""
    sink = _sink(spark, sf_dir, "repeated")
    ends = sink.read(spark, "engagement_metrics").groupBy("track_uri").agg(
        F.sum("skip_count").cast("long").alias("skip_count"), F.sum("natural_end_count").cast("long").alias("natural_end_count"))
    return _counts(sink, spark).join(ends, "track_uri", "full")


def stream_length_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays per track in the leaderboard and the events table, and those put aside for a text too long."""
    sink = _sink(spark, sf_dir, "long")
    events = sink.read(spark, "realtime_streaming_events").groupBy("track_uri").agg(F.count(F.lit(1)).alias("events"))
    aside = sink.read(spark, "quarantine").where(F.col("reason") == LONG_REASON)
    aside = aside.groupBy(F.get_json_object("raw", "$.track_uri").alias("track_uri")).agg(F.count(F.lit(1)).alias("aside"))
    both = _counts(sink, spark).join(events, "track_uri", "full").join(aside, "track_uri", "full")
    return both.select("track_uri", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("plays", "events", "aside")])


def stream_enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the streamed events table, as the sink stores them."""
    return as_doubles(_sink(spark, sf_dir).read(spark, "realtime_streaming_events")).select(*ENRICHED_COLUMNS)


def stream_engagement_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream = batch: skip and natural-end counts per track summed over batches."""
    e = _sink(spark, sf_dir).read(spark, "engagement_metrics")
    return e.groupBy("track_uri").agg(F.sum("skip_count").cast("long").alias("skip_count"),
                                      F.sum("natural_end_count").cast("long").alias("natural_end_count"))


def stream_engagement_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 as one batch writes it: completion rate per track at the sink's four places."""
    e = as_doubles(_sink(spark, sf_dir, "replayed").read(spark, "engagement_metrics"))
    return e.select("track_uri", "completion_rate")


def stream_mood_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream = batch: per-batch sums re-weighted into the overall averages."""
    m = _sink(spark, sf_dir).read(spark, "realtime_mood_metrics")
    n = F.sum("total_streams")
    return m.agg(n.cast("long").alias("total_streams"),
                 present(F.sum("sum_valence") / n).alias("avg_valence"),
                 present(F.sum("sum_energy") / n).alias("avg_energy"))


def stream_windowed_mood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 in streaming: every 10-minute window the final watermark has closed, emitted once."""
    return show(_windows(spark, sf_dir, "mood").select(
        "window_start_time", "window_end_time", "avg_valence", "avg_energy", "total_streams", "sum_valence", "sum_energy"))


def stream_windowed_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 in streaming: plays per track of every closed window."""
    return _windows(spark, sf_dir, "leaderboard").select(
        "window_start_time", "window_end_time", "track_uri", "track_name", "artist_name", "play_count")


def stream_windowed_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 in streaming: engagement per track of every closed window."""
    return show(_windows(spark, sf_dir, "engagement").select(
        "window_start_time", "window_end_time", "track_uri", "completion_rate", "skip_count", "natural_end_count"))


def stream_top_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 + T1 read from the streamed leaderboard table (per-batch counts merged), as the dashboard does."""
    return dashboard(spark, _sink(spark, sf_dir), minutes=None)["top_tracks"]


def stream_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 read from the streamed events table."""
    return dashboard(spark, _sink(spark, sf_dir), minutes=None)["heatmap"]


# Plays whose message has no ts, an unreadable one, or no JSON at all, by event id.
NO_TS, BAD_TS, NO_JSON = 29, 31, 37


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages a stream over all plays puts aside, by reason and play (every 29th, 31st, 37th is damaged)."""
    raw = Workload.of(spark, sf_dir).raw_history
    eid = F.col("event_id")
    ts = F.when(eid % NO_TS == 0, F.lit(None).cast("string")).when(eid % BAD_TS == 0, F.lit("2024-01-01")).otherwise(
        F.substring(F.col("ts").cast("string"), 1, 19))
    names = [f.name for f in LOG_SCHEMA.fields if f.name not in ("ts", "album_name", "ms_played", "shuffle", "skipped")]
    text = F.to_json(F.struct(ts.alias("ts"), eid.cast("string").alias("album_name"), *names))
    lines = raw.select(F.when(eid % NO_JSON == 0, F.concat(F.lit("{"), eid.cast("string"))).otherwise(text).alias("value"))

    def build(spark: SparkSession, sf_dir: str, root: str) -> None:
        lines.write.text(os.path.join(root, "input"))
        _, bad = split_quarantine(replay_stream(spark, os.path.join(root, "input")), raw_col="raw")
        _run(bad.writeStream.format("parquet").option("path", os.path.join(root, "out"))
                .option("checkpointLocation", os.path.join(root, "_checkpoint")).trigger(availableNow=True).start())

    out = spark.read.schema(T.StructType().add("raw", "string").add("reason", "string")).parquet(
        os.path.join(_root(spark, sf_dir, "quarantine", build), "out"))
    event = F.coalesce(F.get_json_object("raw", "$.album_name"), F.substring("raw", 2, 20)).cast("long")
    return out.select(event.alias("event_id"), "reason")


_STREAM = [
    stream_play_counts, stream_replayed_totals, stream_enriched_events, stream_engagement_totals, stream_engagement_rates,
    stream_mood_totals, stream_windowed_mood, stream_windowed_leaderboard, stream_windowed_engagement,
    stream_top_tracks, stream_heatmap, stream_quarantine, stream_committed_totals, stream_compacted_events, stream_late_plays,
    stream_reseeded_mood, stream_salted_leaderboard, stream_salted_engagement, stream_deduplicated_counts,
    stream_length_rules, stream_incremental_artists, stream_incremental_tracks, stream_incremental_albums,
]


def stream_queries() -> dict:
    return {f.__name__: f for f in _STREAM}


def _of_stored_plays(name: str) -> str:
    """The SQL of a dimension over the plays as the events table stores them: completion to four places."""
    plays = f""", stored_plays AS (SELECT * REPLACE ({_p4("completion_rate")} AS completion_rate) FROM enriched)"""
    return PRELUDE + plays + batch_oracle()[name].removeprefix(PRELUDE.rstrip()).replace("FROM enriched ", "FROM stored_plays ")


def _p4(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), 4) AS DOUBLE)"


_BUCKET = """time_bucket(INTERVAL '10 minutes', "timestamp")"""
_CLOSED = """WHERE window_end_time <= (SELECT max("timestamp") FROM enriched) - INTERVAL 1 HOUR"""
_SKIPS = """CAST(SUM(CASE WHEN is_skip THEN 1 ELSE 0 END) AS BIGINT) AS skip_count,
              CAST(SUM(CASE WHEN NOT is_skip THEN 1 ELSE 0 END) AS BIGINT) AS natural_end_count"""


def stream_oracle() -> dict[str, str]:
    stored = ENRICHED_SELECT
    for c in ("energy", "valence", "danceability", "acousticness", "completion_rate"):
        stored = stored.replace(p6(c), _p4(c))
    out = {
        "stream_play_counts": PRELUDE + "SELECT track_uri, COUNT(*) AS plays FROM enriched GROUP BY track_uri",
        "stream_replayed_totals": PRELUDE + f"""
            SELECT track_uri, COUNT(*) AS plays, COUNT(*) AS events, {_SKIPS} FROM enriched GROUP BY track_uri""",
        "stream_committed_totals": PRELUDE + f"""
            SELECT track_uri, COUNT(*) AS plays, COUNT(*) AS events, {_SKIPS} FROM enriched WHERE hour_of_day < 18 GROUP BY track_uri""",
        "stream_compacted_events": PRELUDE + f"SELECT hour_of_day // 6 AS batch_id, {stored} FROM enriched WHERE hour_of_day < 18",
        "stream_incremental_artists": _of_stored_plays("artist_profile"),
        "stream_incremental_tracks": _of_stored_plays("track_profile"),
        "stream_incremental_albums": _of_stored_plays("album_dim"),
        "stream_late_plays": PRELUDE + f"""
            , plays AS (SELECT {_BUCKET} AS window_start_time, CAST(epoch(date_trunc('second', "timestamp")) AS BIGINT) AS s FROM enriched),
            span AS (SELECT min(s) AS a, max(s) AS b FROM plays),
            came AS (SELECT window_start_time, CAST(epoch(window_start_time) AS BIGINT) + 600 AS e, s,
              CAST(floor(CAST((s - a) * 4 AS DOUBLE) / (b - a + 1)) AS BIGINT) + CASE WHEN s % 5 = 0 THEN 1 ELSE 0 END AS k FROM plays, span),
            marks AS (SELECT k, max(max(s)) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3600 AS w FROM came GROUP BY k),
            held AS (SELECT came.*, e <= w AS late FROM came JOIN marks USING (k))
            SELECT window_start_time, CAST(SUM(CASE WHEN late IS TRUE THEN 0 ELSE 1 END) AS BIGINT) AS on_time,
              CAST(SUM(CASE WHEN late IS TRUE THEN 1 ELSE 0 END) AS BIGINT) AS late
            FROM held GROUP BY window_start_time, e
            HAVING e <= (SELECT max(s) FROM came) - 3600""",
        "stream_enriched_events": PRELUDE + f"SELECT {stored} FROM enriched",
        "stream_engagement_totals": PRELUDE + f"SELECT track_uri, {_SKIPS} FROM enriched GROUP BY track_uri",
        "stream_engagement_rates": PRELUDE + f"""
            SELECT track_uri, {_p4("avg(completion_rate)")} AS completion_rate FROM enriched GROUP BY track_uri""",
        "stream_mood_totals": PRELUDE + f"""
            SELECT COUNT(*) AS total_streams, {p6("avg(valence)")} AS avg_valence,
              {p6("avg(energy)")} AS avg_energy FROM enriched""",
        "stream_windowed_mood": PRELUDE + f"""
            SELECT * FROM (
              SELECT {_BUCKET} AS window_start_time, {_BUCKET} + INTERVAL '10 minutes' AS window_end_time,
                {p6("avg(valence)")} AS avg_valence, {p6("avg(energy)")} AS avg_energy, COUNT(*) AS total_streams,
                {p6("sum(valence)")} AS sum_valence, {p6("sum(energy)")} AS sum_energy
              FROM enriched GROUP BY 1, 2) {_CLOSED}""",
        "stream_windowed_leaderboard": PRELUDE + f"""
            SELECT window_start_time, window_end_time, track_uri, first.n AS track_name, first.a AS artist_name, play_count
            FROM (SELECT {_BUCKET} AS window_start_time, {_BUCKET} + INTERVAL '10 minutes' AS window_end_time, track_uri,
                min({{'t': "timestamp", 'n': track_name, 'a': artist_name}}) AS first, COUNT(*) AS play_count
              FROM enriched GROUP BY 1, 2, 3) {_CLOSED}""",
        "stream_windowed_engagement": PRELUDE + f"""
            SELECT * FROM (
              SELECT {_BUCKET} AS window_start_time, {_BUCKET} + INTERVAL '10 minutes' AS window_end_time, track_uri,
                {p6("avg(completion_rate)")} AS completion_rate, {_SKIPS}
              FROM enriched GROUP BY 1, 2, 3) {_CLOSED}""",
        "stream_reseeded_mood": PRELUDE + f"""
            , plays AS (SELECT *, CAST(epoch(date_trunc('second', "timestamp")) AS BIGINT) AS s FROM enriched),
            span AS (SELECT min(s) AS a, max(s) AS b FROM plays),
            scaled AS (SELECT "timestamp", valence * f AS valence, energy * f AS energy FROM (
              SELECT plays.*, CASE WHEN floor(CAST((s - a) * 4 AS DOUBLE) / (b - a + 1)) >= 2 THEN 0.5 ELSE 1.0 END::DOUBLE AS f FROM plays, span))
            SELECT * FROM (
              SELECT {_BUCKET} AS window_start_time, {_BUCKET} + INTERVAL '10 minutes' AS window_end_time,
                {p6("avg(valence)")} AS avg_valence, {p6("avg(energy)")} AS avg_energy, COUNT(*) AS total_streams,
                {p6("sum(valence)")} AS sum_valence, {p6("sum(energy)")} AS sum_energy
              FROM scaled GROUP BY 1, 2) {_CLOSED}""",
        "stream_length_rules": PRELUDE + f"""
            SELECT spotify_track_uri AS track_uri, COUNT(*) FILTER (event_id % {LONG_NAME} <> 0) AS plays,
              COUNT(*) FILTER (event_id % {LONG_NAME} <> 0) AS events, COUNT(*) FILTER (event_id % {LONG_NAME} = 0) AS aside
            FROM history GROUP BY 1""",
        "stream_deduplicated_counts": PRELUDE + f"""
            SELECT track_uri, COUNT(*) AS plays, {_SKIPS} FROM (
              SELECT spotify_track_uri AS track_uri, skipped OR COALESCE(contains(lower(reason_end), 'skip'), false) AS is_skip
              FROM (SELECT DISTINCT * EXCLUDE (event_id) FROM history)) GROUP BY track_uri""",
        "stream_top_tracks": PRELUDE + """
            SELECT track_name, artist_name, COUNT(*) AS plays FROM enriched
            GROUP BY track_name, artist_name ORDER BY plays DESC, track_name, artist_name LIMIT 10""",
        "stream_heatmap": PRELUDE + """
            SELECT day_of_week, hour_of_day, COUNT(*) AS plays FROM enriched GROUP BY day_of_week, hour_of_day""",
        "stream_quarantine": PRELUDE + f"""
            SELECT event_id, CASE WHEN event_id % {NO_JSON} <> 0 AND event_id % {NO_TS} <> 0
              AND event_id % {BAD_TS} = 0 THEN 'unreadable ts' ELSE 'missing ts' END AS reason
            FROM raw_history WHERE event_id % {NO_JSON} = 0 OR event_id % {NO_TS} = 0 OR event_id % {BAD_TS} = 0""",
    }
    # the store's features that these use are the same in both versions
    out["stream_salted_leaderboard"] = out["stream_windowed_leaderboard"]
    out["stream_salted_engagement"] = out["stream_windowed_engagement"]
    return out
