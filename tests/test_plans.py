"""Plan checks: no Python in the hot path, pushed-down filters and pruned columns,
checked broadcast, and the streaming join meeting a pre-partitioned track tier."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from cadence.operators import panels
from cadence.operators.sizing import broadcast_if_small, measured_bytes
from cadence.plans.registry import batch_queries
from cadence.plans.workload import Workload
from cadence.schemas import ENRICHED_SCHEMA
from cadence.streaming.job import FeatureStore

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_anywhere(spark):
    for name, q in batch_queries().items():
        p = _plan(q(spark, SF_SMALL))
        assert "PythonUDF" not in p and "EvalPython" not in p, name


def test_lookback_filter_reaches_parquet_scan(spark, scratch):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=i), "t", "n", "a", "A", 1, 0.5, 0.5, 0.5, 0.5, 1000, 2000, 1.0, False, 0, 1)
            for i in range(100)]
    path = os.path.join(scratch, "events")
    spark.createDataFrame(rows, ENRICHED_SCHEMA).write.parquet(path)
    ev = spark.read.parquet(path)
    as_of = F.lit("2024-01-01 01:39:00").cast("timestamp_ntz")
    df = panels.kpi(ev, minutes=30, as_of=as_of)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan
    assert "ReadSchema: struct<timestamp:timestamp_ntz,energy:double,valence:double,completion_rate:double,is_skip:boolean>" in plan
    assert df.first().total_events == 31


def test_checked_broadcast(spark):
    small = spark.range(100).withColumn("s", F.lit("abc"))
    assert 0 < measured_bytes(small) < 10_000
    assert "ResolvedHint" in small.transform(broadcast_if_small)._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in small.transform(broadcast_if_small)._jdf.queryExecution().analyzed().toString().lower()
    assert broadcast_if_small(small, 10) is small


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    return old


def test_stream_batch_join_does_not_reshuffle_tracks(spark):
    """A micro-batch meets the persisted, hash-partitioned track tier without shuffling it again."""
    from cadence.operators.enrich import enrich
    old = _no_broadcast(spark)
    w = Workload(spark, SF_SMALL)
    store = FeatureStore.prepare(w.tracks, w.artists, w.global_row, max_broadcast_bytes=1)
    try:
        e = enrich(w.history, store.tracks, store.artists, store.global_row, artist_broadcast_bytes=-1)
        e.write.format("noop").mode("overwrite").save()
        plan = e._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [coalesce(spotify_track_uri" in plan
        assert re.search(r"Exchange hashpartitioning\(coalesce\(spotify_track_uri#\d+, .*, \d+\), ENSURE_REQUIREMENTS", plan)
        # the only exchange on the track id is the one inside the cached relation
        assert not re.search(r"Exchange hashpartitioning\((id|_t_key)#\d+, \d+\), ENSURE_REQUIREMENTS", plan)
        assert re.search(r"Exchange hashpartitioning\(id#\d+, \d+\), REPARTITION_BY_NUM", plan)
    finally:
        store.release()
        _restore(spark, old)


def test_hot_track_partition_is_split(spark):
    """One track with a third of all plays: AQE splits its shuffle partition in the track join."""
    from cadence.operators.enrich import enrich
    old = _no_broadcast(spark)
    extra = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    for k, v in extra.items():
        old[k] = spark.conf.get(k)
        spark.conf.set(k, v)
    try:
        w = Workload(spark, SF_SMALL)
        h = w.history
        hot = h.where(F.col("event_id") % 3 == 0).withColumn("spotify_track_uri", F.lit("t1"))
        skewed = h.where(F.col("event_id") % 3 != 0).unionByName(hot).repartition(8)
        e = enrich(skewed, w.tracks, w.artists, w.global_row, artist_broadcast_bytes=-1)
        rows = e.collect()             # runs this frame's own plan (small fixture)
        plan = e._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert re.search(r"SortMergeJoin\(skew=true\) \[coalesce\(spotify_track_uri#\d+", plan), plan
        assert len(rows) == h.count()
    finally:
        _restore(spark, old)


def test_lookback_prunes_result_partitions(spark, scratch):
    from cadence.sources.sinks import TableSink, conform
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=6 * i), "t", "n", "a", "A", 1, 0.5, 0.5, 0.5, 0.5, 1000, 2000, 1.0, False, 0, 1)
            for i in range(20)]
    sink = TableSink(scratch)
    ev = conform(spark.createDataFrame(rows, ENRICHED_SCHEMA), "realtime_streaming_events")
    sink.write(ev, "realtime_streaming_events", batch_id=0)
    table = sink.read(spark, "realtime_streaming_events")
    as_of = F.lit("2024-01-05 18:00:00").cast("timestamp_ntz")
    df = panels.kpi(table, minutes=12 * 60, as_of=as_of)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(dt#\d+\), \(dt#\d+ >= ", plan)
    assert df.first().total_events == 3


def test_hot_track_split_against_persisted_tier(spark):
    """Against the persisted track tier (no AQE split possible) the hot track is joined map-side."""
    from pyspark import StorageLevel

    from cadence.operators.enrich import enrich
    from cadence.operators.skew import hot_keys
    old = _no_broadcast(spark)
    w = Workload(spark, SF_SMALL)
    store = FeatureStore.prepare(w.tracks, w.artists, w.global_row, max_broadcast_bytes=1)
    try:
        h = w.history
        hot = h.where(F.col("event_id") % 3 == 0).withColumn("spotify_track_uri", F.lit("t1"))
        skewed = h.where(F.col("event_id") % 3 != 0).unionByName(hot).persist(StorageLevel.MEMORY_AND_DISK)
        assert [r[0] for r in hot_keys(skewed, "spotify_track_uri", 0.1).collect()] == ["t1"]
        plain = enrich(skewed, store.tracks, store.artists, store.global_row, artist_broadcast_bytes=-1)
        split = enrich(skewed, store.tracks, store.artists, store.global_row, artist_broadcast_bytes=-1,
                       hot_track_fraction=0.1)
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [spotify_track_uri" in plan and "SortMergeJoin [spotify_track_uri" in plan
        skewed.unpersist()
    finally:
        store.release()
        _restore(spark, old)


RECENT = ["kpi_recent", "top_tracks_recent", "events_per_second_recent", "mood_timeline_recent"]


def test_lookbacks_prune_the_enriched_table(spark):
    for name in RECENT:
        plan = _plan(batch_queries()[name](spark, SF_SMALL))
        assert re.search(r"PartitionFilters: \[[^\]]*\(?dt#\d+ >= ", plan), name


def test_first_seen_names_are_hash_aggregated_before_the_shuffle(spark):
    for name in ("leaderboard", "windowed_leaderboard", "top_tracks", "top_tracks_recent", "track_profile", "album_dim"):
        plan = _plan(batch_queries()[name](spark, SF_SMALL))
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "FileScan" in line and "enriched" in line:      # upwards from the scan to the first exchange
                above = []
                for up in reversed(lines[:i]):
                    if "Exchange" in up:
                        break
                    above.append(up)
                assert not any("SortAggregate" in x for x in above), name


def test_newest_points_read_the_newest_days_only(spark, scratch):
    """Older ``dt`` folders aren't read once the newest days hold enough rows; rows are the same."""
    from cadence.operators import panels
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("id") / 100).cast("int"))
    table = spark.range(1000).select(
        F.timestamp_add("SECOND", F.col("id") % 100, day.cast("timestamp_ntz")).alias("timestamp"), F.concat(F.lit("a"), F.col("id")).alias("artist_name"),
        (F.col("id") / 1000).alias("valence"), F.lit(0.5).alias("energy"), day.alias("dt"))
    undated = spark.createDataFrame([(None, "none", 0.0, 0.0, None)], table.schema)
    table.unionByName(undated).write.partitionBy("dt").parquet(f"{scratch}/samples")
    stored = spark.read.parquet(f"{scratch}/samples")
    columns = ["timestamp", "artist_name", "valence", "energy"]
    never = F.lit("0001-01-01").cast("date")
    for n, days in ((1, 1), (100, 1), (101, 2), (250, 3), (1000, 10), (1001, 11), (5000, 11)):
        want = stored.select(*columns).orderBy(F.col("timestamp").desc(), *columns[1:]).limit(n)
        assert panels.mood_scatter(stored, minutes=None, n=n).collect() == want.collect(), n
        assert panels.newest_days(stored, n).select(F.countDistinct(F.coalesce("dt", never))).first()[0] == days, n
    assert panels.mood_scatter(stored.where("false"), minutes=None).count() == 0
    plan = panels.newest_days(stored, 250).select("valence")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[\(coalesce\(dt#\d+, 0001-01-01\) >= coalesce\((Reused)?[Ss]ubquery", plan), plan
    assert re.search(r"DataFilters: \[\].*ReadSchema: struct<>", plan), plan  # days are counted without a column


def test_hot_keys_are_counted_once(spark):
    """The plan holds the hot keys as values: no half of the join counts the plays again."""
    from cadence.operators.skew import split_hot_join
    left = spark.createDataFrame([("a", i) for i in range(30)] + [(f"k{i}", i) for i in range(30)] + [(None, 0)], "k string, n int")
    right = spark.createDataFrame([("a", "A"), ("k1", "B")], "id string, v string")
    split = split_hot_join(left, right, "k", "id", "left", 0.2)
    assert "Aggregate" not in split._jdf.queryExecution().optimizedPlan().toString()
    plain = left.join(right, left["k"] == right["id"], "left")
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_history_is_derived_once_for_the_batches_of_a_run(spark, scratch):
    from cadence.plans.stream_queries import _laid_out
    rows = [(f"p{i}", i % 3 if i % 7 else None) for i in range(50)]
    path = os.path.join(scratch, "history")
    plays = _laid_out(spark.createDataFrame(rows, "name string, _quarter long"), "_quarter", path)
    one = plays.where(F.col("_quarter") == 1)
    assert "PartitionFilters: [isnotnull(_quarter" in _plan(one)
    assert sorted(map(str, plays.collect())) == sorted(f"Row(name={n!r}, _quarter={q!r})" for n, q in rows)
    assert one.count() == sum(q == 1 for _, q in rows)
