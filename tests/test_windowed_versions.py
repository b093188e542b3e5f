"""Versions of the feature store, salted windows, and messages sent twice."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.schemas import ENRICHED_SCHEMA
from cadence.sources.kafka import parse_logs
from cadence.streaming.repeats import drop_repeats
from cadence.streaming.replay import replay_stream
from cadence.streaming.versions import EnrichedBatches, VersionedStore, enriched_batches, start_enriched
from cadence.streaming.windows import EVENT_TIME, KINDS, start_windowed, state_partitions

NOW = {"availableNow": True}
SCHEMA = T.StructType([*ENRICHED_SCHEMA.fields]).add(EVENT_TIME, "timestamp")


def _tiers(spark, valence):
    feats = "valence double, energy double, danceability double, acousticness double, duration_ms double, year double"
    row = (valence, 0.5, 0.5, 0.5, 1000.0, 2000.0)
    return (spark.createDataFrame([("t1", *row)], "id string, " + feats), spark.createDataFrame([], "artist string, " + feats),
            spark.createDataFrame([tuple(x / 2 for x in row)], feats))


def _line(second, track="t1", skip="false", name="n"):
    ts = f"2024-01-01 {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"
    return f'{{"ts":"{ts}","ms_played":500,"spotify_track_uri":"{track}","track_name":"{name}","artist_name":"a","skipped":{skip}}}'


def _add(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(2).write.mode("append").text(path)


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def test_versions_are_listed_when_whole(spark, scratch):
    store = VersionedStore(spark, scratch)
    assert store.versions() == []
    assert [store.publish(*_tiers(spark, v)) for v in (0.25, 0.75)] == [0, 1]
    spark.range(1).write.parquet(os.path.join(scratch, "store-broken", "tracks"))   # a try that was never listed
    other = VersionedStore(spark, scratch)
    assert other.versions() == [0, 1]
    assert [other.tiers(v)[0].first()["valence"] for v in (0, 1)] == [0.25, 0.75]
    other.expire(1)
    assert store.versions() == [1] and store.tiers(1)[0].count() == 1


def test_a_batch_keeps_the_version_it_began_with(spark, scratch):
    store, root = VersionedStore(spark, os.path.join(scratch, "store")), os.path.join(scratch, "enriched")
    store.publish(*_tiers(spark, 0.25))
    handler = EnrichedBatches(store, root)
    batch = parse_logs(spark.createDataFrame([(_line(1),), (_line(2, "other"),), ("junk",)], "value string"))
    assert handler.version_of(0) == 0                      # recorded, then the run stops
    store.publish(*_tiers(spark, 0.75))
    again = EnrichedBatches(store, root)
    again(batch, 0)
    again(batch, 0)                                        # already there
    again(batch, 1)
    rows = spark.read.parquet(os.path.join(root, "batch-*")).withColumn("b", F.input_file_name()).collect()
    got = sorted((r["b"].split("/batch-")[1][0], r["track_uri"], r["valence"]) for r in rows)
    assert got == [("0", "other", 0.125), ("0", "t1", 0.25), ("1", "other", 0.375), ("1", "t1", 0.75)]
    assert not [f for f in os.listdir(root) if f.startswith("_trial")]
    again.release()


def test_windows_see_a_new_version_without_a_restart(spark, scratch):
    inp, store = os.path.join(scratch, "in"), VersionedStore(spark, os.path.join(scratch, "store"))
    handler = EnrichedBatches(store, os.path.join(scratch, "enriched"))
    q = None
    for k, valence in enumerate((0.25, 0.75, 0.75)):
        if k < 2:
            store.publish(*_tiers(spark, valence))
        _add(spark, inp, [_line(3600 * k + s) for s in range(10)])
        _run(start_enriched(replay_stream(spark, inp), handler, os.path.join(scratch, "ck"), NOW))
        if q is None:   # one query for all batches, on a short trigger
            q = start_windowed(enriched_batches(spark, handler.root, SCHEMA, "1 minute"), os.path.join(scratch, "mood"),
                               os.path.join(scratch, "ck-mood"), kind="mood", size="1 minute", trigger={"processingTime": "100 milliseconds"}, salts=4)
        q.processAllAvailable()
    q.stop()
    rows = spark.read.parquet(os.path.join(scratch, "mood")).orderBy("window_start_time").collect()
    assert [(r["window_start_time"].hour, r["avg_valence"], r["total_streams"]) for r in rows] == [(0, 0.25, 10), (1, 0.75, 10)]
    handler.release()


def _windowed(spark, scratch, enriched, kind, salts):
    out = os.path.join(scratch, f"{kind}-{salts}")
    _run(start_windowed(enriched_batches(spark, enriched, SCHEMA, "1 minute"), out, out + "-ck", kind=kind, size="1 hour", trigger=NOW, salts=salts))
    return out


def test_salted_windows_spread_a_hot_track_and_give_the_same_rows(spark, scratch):
    store, inp = VersionedStore(spark, os.path.join(scratch, "store")), os.path.join(scratch, "in")
    store.publish(*_tiers(spark, 0.25))
    handler = EnrichedBatches(store, os.path.join(scratch, "enriched"))
    lines = [_line(s % 3000, "t1" if s % 3 == 0 else f"x{s}", "true" if s % 5 == 0 else "false", f"name {s % 2}") for s in range(9000)]
    _add(spark, inp, lines + [_line(7 * 3600)])            # the last play closes the first hour
    _run(start_enriched(replay_stream(spark, inp), handler, os.path.join(scratch, "ck"), NOW))
    for kind in KINDS:
        plain, salted = (spark.read.parquet(_windowed(spark, scratch, handler.root, kind, n)) for n in (1, 16))
        assert plain.columns == salted.columns
        rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in plain.dtypes]
        a, b = plain.select(*rounded), salted.select(*rounded)
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()
        types = {f.name: f.dataType for f in plain.schema}
        assert types == {f.name: f.dataType for f in salted.schema}
    handler.release()


def test_state_of_a_hot_track_lies_in_all_partitions(spark, scratch):
    """Plays that the state of each partition stands for, while the window is open."""
    store, inp = VersionedStore(spark, os.path.join(scratch, "store")), os.path.join(scratch, "in")
    store.publish(*_tiers(spark, 0.25))
    handler = EnrichedBatches(store, os.path.join(scratch, "enriched"))
    _add(spark, inp, [_line(s % 3000, "t1" if s % 3 == 0 else f"x{s}") for s in range(9000)])
    _run(start_enriched(replay_stream(spark, inp), handler, os.path.join(scratch, "ck"), NOW))
    share = {}
    for salts, operator in ((1, 0), (64, 1)):              # the first of two chained steps is the lower operator
        ck = _windowed(spark, scratch, handler.root, "engagement", salts) + "-ck"
        state = spark.read.format("statestore").option("operatorId", operator).load(ck)
        kinds = state.schema["value"].dataType.fields      # the buffers share names; the last counts plays that aren't skips
        value = F.col("value").cast(T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kinds)]))
        plays = state.groupBy("partition_id").agg(F.sum(value[f"c{len(kinds) - 1}"]).alias("n")).collect()
        n = [r["n"] or 0 for r in plays]
        share[salts] = max(n) / (sum(n) / 8)
    assert share[1] > 2 and share[64] < 2, share
    handler.release()


def test_state_partitions_follow_the_cores_and_not_the_shuffles(spark, scratch):
    """Each state task reports a metric per state partition: many partitions cost the square of their number."""
    store, inp = VersionedStore(spark, os.path.join(scratch, "store")), os.path.join(scratch, "in")
    store.publish(*_tiers(spark, 0.25))
    handler = EnrichedBatches(store, os.path.join(scratch, "enriched"))
    _add(spark, inp, [_line(s) for s in range(30)] + [_line(7 * 3600)])
    _run(start_enriched(replay_stream(spark, inp), handler, os.path.join(scratch, "ck"), NOW))
    key, provider = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"
    before, kind = spark.conf.get(key), spark.conf.get(provider)
    spark.conf.set(key, "96")
    try:
        most = max(8, spark.sparkContext.defaultParallelism)
        assert state_partitions(spark) == min(96, most)
        out = _windowed(spark, scratch, handler.root, "engagement", 4)
        assert spark.conf.get(key) == "96" and spark.conf.get(provider) == kind      # the session's settings are as before
        spark.conf.set(key, "2")
        assert state_partitions(spark) == 2                # never more than the session's shuffles
    finally:
        spark.conf.set(key, before)
    operators = spark.read.format("state-metadata").load(out + "-ck").collect()
    assert len(operators) == 2 and {r["numPartitions"] for r in operators} == {min(96, most)}
    assert [(r["window_start_time"].hour, r["skip_count"], r["natural_end_count"]) for r in spark.read.parquet(out).collect()] == [(0, 0, 30)]
    handler.release()


def test_messages_sent_twice_count_once(spark, scratch):
    inp = os.path.join(scratch, "in")
    seen = []

    def keep(batch, batch_id):
        seen.append(sorted(r["raw"] for r in batch.collect()))

    first, second = [_line(1), _line(2), _line(1), "junk"], [_line(2), _line(3), '{"ts":null}', "junk"]
    for lines in (first, second):
        _add(spark, inp, lines)
        _run(drop_repeats(replay_stream(spark, inp), "1 day").writeStream.foreachBatch(keep)
             .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    got = [rows for rows in seen if rows]
    assert got == [sorted({_line(1), _line(2), "junk"}), sorted([_line(3), '{"ts":null}'])]


def test_repeats_by_named_keys_in_batch(spark):
    logs = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), (None, 1, "z"), (None, 1, "z"), ("null", 1, "w")], "id string, n int, raw string")
    assert drop_repeats(logs, keys=["id", "n"]).count() == 3
    assert drop_repeats(logs).count() == 4
    assert drop_repeats(logs.limit(0)).isEmpty() and drop_repeats(logs).columns == logs.columns
