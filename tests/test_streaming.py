"""Streaming: stream = batch, idempotent replay, restart from checkpoint, quarantine, windows, progress."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from cadence.operators import metrics
from cadence.operators.enrich import spread_nulls
from cadence.plans.workload import Workload
from cadence.sources.files import load_feature_store, write_feature_store
from cadence.sources.kafka import parse_logs
from cadence.sources.sinks import TableSink
from cadence.streaming.job import FeatureStore, WatchedStore, batch_stamp, process_batch, start_stream_job
from cadence.streaming.progress import ProgressRecorder
from cadence.streaming.replay import log_lines, replay_stream
from cadence.streaming.windows import enriched_stream, start_windowed

from .conftest import SF_SMALL
from .helpers import write_replay_files


def _setup(spark, root):
    w = Workload(spark, SF_SMALL)
    tr, ar, gr = load_feature_store(spark, os.path.join(root, "store"), catalog=w.catalog)
    return w, FeatureStore.prepare(tr, ar, gr)


def _counts(df, key="track_uri", val="play_count"):
    return {r[0]: r[1] for r in df.groupBy(key).agg(F.sum(val)).collect()}


def test_stream_equals_batch_and_restart(spark, scratch):
    w, store = _setup(spark, scratch)
    hist = w.history.cache()
    early = hist.where(F.col("ts") < "2024-01-15 00:00:00")
    late = hist.where(F.col("ts") >= "2024-01-15 00:00:00")
    inp = os.path.join(scratch, "input")
    write_replay_files(early, os.path.join(inp, "part=1"), 2)
    sink = TableSink(os.path.join(scratch, "tables"))
    ck = os.path.join(scratch, "ck")

    q = start_stream_job(replay_stream(spark, inp, 1), store, sink, ck, trigger={"availableNow": True})
    q.awaitTermination()
    first = sink.read(spark, "realtime_leaderboard").select("batch_id").distinct().count()
    assert first == 2

    # restart from the checkpoint: only the new files are processed
    write_replay_files(late, os.path.join(inp, "part=2"), 2)
    q = start_stream_job(replay_stream(spark, inp, 1), store, sink, ck, trigger={"availableNow": True})
    q.awaitTermination()
    lb = sink.read(spark, "realtime_leaderboard")
    assert lb.select("batch_id").distinct().count() == 4
    batch = _counts(metrics.leaderboard(w.enriched))
    assert _counts(lb) == batch
    assert sink.read(spark, "realtime_streaming_events").count() == w.enriched.count()
    assert sink.read(spark, "quarantine").count() == 0

    # the dashboard over the streamed tables, last 30 minutes before the newest play
    from cadence.plans.dashboard import dashboard
    newest = sink.read(spark, "realtime_streaming_events").agg(F.max("timestamp")).first()[0]
    as_of = F.lit(newest.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    board = dashboard(spark, sink, minutes=30, as_of=as_of)
    recent = w.enriched.where(F.col("timestamp") >= F.lit(newest) - F.expr("INTERVAL 30 MINUTES")).count()
    assert board["kpi"].first().total_events == recent
    assert sum(r.plays for r in board["heatmap"].collect()) == recent
    for name, df in board.items():
        df.collect()
    store.release()


def test_replayed_batch_is_idempotent_and_quarantines(spark, scratch):
    w, store = _setup(spark, scratch)
    lines = [r.value for r in w.history.limit(20).select(F.to_json(F.struct("*")).alias("value")).collect()]
    lines += ["junk", '{"ts":"bad"}']
    batch = parse_logs(spark.createDataFrame([(x,) for x in lines], "value string"))
    sink = TableSink(os.path.join(scratch, "tables"))
    assert process_batch(batch, 7, store, sink)
    assert process_batch(batch, 7, store, sink)          # replay of the same batch id
    assert sink.read(spark, "realtime_streaming_events").count() == 20
    assert sink.read(spark, "mood_matrix_samples").count() == 20
    q = sink.read(spark, "quarantine").collect()
    assert sorted(r.reason for r in q) == ["missing ts", "unreadable ts"]
    mood = sink.read(spark, "realtime_mood_metrics").first()
    assert mood.total_streams == 20 and str(sink.read(spark, "realtime_mood_metrics").schema["avg_valence"]
                                           .dataType) == "DecimalType(5,4)"
    empty = batch.limit(0)
    assert not process_batch(empty, 8, store, sink)
    store.release()


def test_missing_table_reads_empty(spark, scratch):
    df = TableSink(scratch).read(spark, "realtime_leaderboard")
    assert df.count() == 0 and "play_count" in df.columns


def test_windowed_stream_with_watermark(spark, scratch):
    w, store = _setup(spark, scratch)
    inp = os.path.join(scratch, "input")
    write_replay_files(w.history, inp, 3)
    out, ck = os.path.join(scratch, "win"), os.path.join(scratch, "winck")
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # windows must not depend on it
    try:
        q = start_windowed(enriched_stream(replay_stream(spark, inp, 1), store, "1 hour"), out, ck, kind="mood",
                           size="1 day", trigger={"availableNow": True})
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
    got = spark.read.parquet(out)
    batch = metrics.windowed_mood(w.enriched, "1 day")
    # closed windows only: everything but the windows the watermark has not passed yet
    assert got.count() >= 1
    joined = got.join(batch, "window_start_time").where(got.total_streams != batch.total_streams)
    assert joined.count() == 0
    store.release()


def test_progress_metrics(spark, scratch):
    w, store = _setup(spark, scratch)
    inp = os.path.join(scratch, "input")
    write_replay_files(w.history, inp, 3)
    sink = TableSink(os.path.join(scratch, "t"))
    rec = ProgressRecorder(spark, sink, every=2).attach()      # written while the queries run, two reports at a time
    try:
        for name in ("ck", "ck2"):                     # two queries with the same batch ids
            q = start_stream_job(replay_stream(spark, inp, 1), store, TableSink(os.path.join(scratch, name + "_t")),
                                 os.path.join(scratch, name), trigger={"availableNow": True})
            q.awaitTermination()
    finally:
        rec.close()
        store.release()
    rows = sink.read(spark, "system_metrics").collect()
    assert len(rows) == 6 and len({(r.query_id, r.run_id) for r in rows}) == 2
    assert all(r.spark_processing_delay_ms >= 0 for r in rows)


def test_batch_replayed_on_the_next_day_counts_once(spark, scratch):
    w, store = _setup(spark, scratch)
    batch = parse_logs(log_lines(w.history.limit(20)), "value")
    sink = TableSink(os.path.join(scratch, "tables"))
    process_batch(batch, 3, store, sink, when=dt.datetime(2024, 3, 1, 23, 59, 59))
    process_batch(batch, 4, store, sink, when=dt.datetime(2024, 3, 1, 23, 59, 59))
    process_batch(batch, 3, store, sink, when=dt.datetime(2024, 3, 2, 0, 0, 5))
    for name, n in (("realtime_streaming_events", 40), ("realtime_mood_metrics", 2), ("mood_matrix_samples", 40)):
        assert sink.read(spark, name).count() == n, name
    stamps = {r.batch_id: str(r.window_start_time) for r in sink.read(spark, "realtime_mood_metrics").collect()}
    assert stamps == {3: "2024-03-02 00:00:05", 4: "2024-03-01 23:59:59"}
    # a retry that has no row for a table empties the batch's part of it
    sink.write(sink.read(spark, "realtime_mood_metrics").limit(0).drop("batch_id", "dt"), "realtime_mood_metrics", 4)
    assert [r.batch_id for r in sink.read(spark, "realtime_mood_metrics").collect()] == [3]
    store.release()


def test_stamp_and_lookback_share_one_clock(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        gap = spark.range(1).select((F.unix_seconds(F.localtimestamp().cast("timestamp")) - F.unix_seconds(batch_stamp(spark).cast("timestamp"))).alias("s")).first().s
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert 0 <= gap < 60


def test_log_lines_keep_rows_without_ts(spark):
    w = Workload(spark, SF_SMALL)
    h = w.history.withColumn("ts", F.when(F.col("event_id") % 10 != 0, F.col("ts")))
    assert log_lines(h).count() == w.history.count()


def test_store_written_again_reaches_the_next_batch(spark, scratch):
    w = Workload(spark, SF_SMALL)
    path = os.path.join(scratch, "store")
    store = WatchedStore(spark, path, w.catalog)
    batch = parse_logs(log_lines(w.history.limit(30)), "value")
    sink = TableSink(os.path.join(scratch, "tables"))
    process_batch(batch, 1, store, sink)
    first = store.current()
    assert store.current() is first
    time.sleep(1.1)                                    # store times have seconds on some file systems
    one = [F.lit(0.25).alias(c) if c in ("energy", "valence") else F.col(c) for c in w.tracks.columns]
    write_feature_store(w.tracks.select(*one), w.artists.withColumn("energy", F.lit(0.25)), w.global_row.withColumn("energy", F.lit(0.25)), path)
    process_batch(batch, 2, store, sink)
    assert store.current() is not first
    got = {r.batch_id: r.e for r in sink.read(spark, "realtime_streaming_events").groupBy("batch_id").agg(F.max("energy").alias("e")).collect()}
    assert float(got[2]) == 0.25 and float(got[1]) > 0.25
    store.release()


def test_null_and_hot_tracks_on_every_join_path(spark, scratch):
    """A third of the plays without a track, a third on one track: same rows on all paths, nulls spread or map-side."""
    from cadence.operators.enrich import enrich
    w, store = _setup(spark, scratch)
    third = F.col("event_id") % 3
    h = w.history.withColumn("spotify_track_uri", F.when(third == 0, F.lit(None).cast("string")).when(third == 1, F.lit("t1")).otherwise(F.col("spotify_track_uri")))
    h = h.persist()
    plain = enrich(h, w.tracks, w.artists, w.global_row)
    split = enrich(h, store.tracks, store.artists, store.global_row, artist_broadcast_bytes=-1, hot_track_fraction=0.1)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    logs = parse_logs(log_lines(h.drop("event_id")), "value")
    assert enriched_stream(logs, store).count() == h.count()
    keys = h.where("spotify_track_uri is null").select(spread_nulls("spotify_track_uri", h).alias("k"))
    assert keys.distinct().count() > 0.9 * keys.count()
    h.unpersist()
    store.release()
