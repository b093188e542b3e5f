"""Sources and sinks: CSV, feature store, log parsing, contracts, Parquet and JDBC result tables."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cadence.operators import panels, prepare
from cadence.plans.workload import Workload
from cadence.sources.files import (
    features_of_json,
    load_feature_store,
    read_catalog,
    read_history,
    store_exists,
    write_feature_store,
    write_history,
)
from cadence.sources.kafka import parse_logs
from cadence.sources.sinks import LONG_REASON, NULL_REASON, JdbcSink, TableSink, conform, split_violations, violation
from cadence.streaming.progress import ProgressRecorder, progress_row

from .conftest import SF_SMALL

CATALOG_CSV = """id,artists,valence,energy,danceability,acousticness,instrumentalness,liveness,loudness,speechiness,tempo,popularity,duration_ms,explicit,year
a1,"['Ann', 'Bob']",0.5,0.6,0.7,0.1,0.0,0.2,-5.5,0.04,120.0,40,200000,0,1999
a2,"[""Guns N' Roses""]",0.3,0.9,0.4,0.05,0.1,0.3,-3.0,0.05,140.0,80,250000,1,1987
a3,['Cy'],0.1,,0.2,0.9,0.8,0.1,-12.0,0.03,80.0,10,180000,0,2010
"""

HISTORY_CSV = """ts,ms_played,spotify_track_uri,track_name,album_name,artist_name,shuffle,skipped,reason_end
2024-01-01 10:00:00,1000.7,a1,s1,al,Ann,TRUE,FALSE,trackdone
2024-01-01 10:01:00,,a2,s2,al,Guns N' Roses,false,True,fwdbtn
2024-01-01 10:02:00,5,,s3,al,X,TRUE,,
"""


def test_csv_sources_and_cleaning(spark, scratch):
    cp, hp = os.path.join(scratch, "catalog.csv"), os.path.join(scratch, "history.csv")
    open(cp, "w").write(CATALOG_CSV)
    open(hp, "w").write(HISTORY_CSV)
    cat = read_catalog(spark, cp)
    clean = prepare.clean_catalog(cat).orderBy("id").collect()
    assert [(r.id, r.artist) for r in clean] == [("a1", "Ann"), ("a2", "Guns N' Roses")]   # a3 has a null
    hist = prepare.clean_history(read_history(spark, hp)).orderBy("ts").collect()
    assert [(r.ms_played, r.shuffle, r.skipped) for r in hist] == [(1000, True, False), (0, False, True)]
    out = os.path.join(scratch, "clean_csv")
    write_history(prepare.clean_history(read_history(spark, hp)), out, fmt="csv")
    assert spark.read.option("header", True).csv(out).count() == 2


def test_feature_store_build_and_load(spark, scratch):
    w = Workload(spark, SF_SMALL)
    path = os.path.join(scratch, "store")
    assert not store_exists(spark, path)
    tracks, artists, glob = load_feature_store(spark, path, catalog=w.catalog)
    assert store_exists(spark, path)
    assert tracks.count() == w.tracks.count() and glob.count() == 1
    assert artists.join(w.artists, ["artist"] + list(w.artists.columns[1:]), "left_anti").count() == 0
    # the keyed JSON form: one line per key, value = features as JSON
    write_feature_store(w.tracks, w.artists, w.global_row, os.path.join(scratch, "json"), fmt="json")
    keyed = spark.read.json(os.path.join(scratch, "json", "keyed"))
    assert keyed.where(F.col("key") == "global:OTHERS").count() == 1
    assert keyed.count() == w.tracks.count() + w.artists.count() + 1


def test_parse_logs_handles_nan_text_and_junk(spark):
    lines = ['{"ts": "2024-01-01 00:00:00", "ms_played": 5, "track_name": NaN, "skipped": true}',
             "not json", '{"ts": "2024-01-01 00:00:01", "ms_played": 1.7, "shuffle": "TRUE"}']
    rows = parse_logs(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert rows[0].track_name is None and rows[0].skipped is True and rows[0].ms_played == 5
    assert rows[1].ts is None and rows[1].raw == "not json"
    assert rows[2].ms_played is None and rows[2].shuffle is None


def test_conform_and_violations(spark):
    df = spark.createDataFrame([(None, "t", 0.123456, 3, 2)],
                               "window_start_time timestamp_ntz, track_uri string, completion_rate double, "
                               "skip_count long, natural_end_count long")
    c = conform(df, "engagement_metrics")
    assert str(c.schema["completion_rate"].dataType) == "DecimalType(5,4)"
    assert float(c.first().completion_rate) == 0.1235
    ok, broken = split_violations(c, "engagement_metrics")
    assert (ok.count(), broken.count()) == (0, 1)
    art = conform(spark.createDataFrame([("A",)], "artist_name string"), "artists").first()
    assert art.total_play_count == 0 and art.likeability_score is None


def test_panels_on_result_tables(spark, scratch):
    sink = TableSink(scratch)
    rows = [(dt.datetime(2024, 1, 1, 10, m), 0.5, 0.5, 10, 5.0, 5.0) for m in range(0, 60, 10)]
    mood = spark.createDataFrame(rows, "window_start_time timestamp_ntz, avg_valence double, avg_energy double, "
                                       "total_streams long, sum_valence double, sum_energy double")
    sink.write(conform(mood, "realtime_mood_metrics"), "realtime_mood_metrics", batch_id=1)
    t = panels.mood_timeline(sink.read(spark, "realtime_mood_metrics"), minutes=25,
                             as_of=F.lit("2024-01-01 10:50:00").cast("timestamp_ntz")).collect()
    assert [r.window_start_time.minute for r in t] == [30, 40, 50]


def test_jdbc_sink_embedded(spark):
    url = "jdbc:derby:memory:cadence_test;create=true"
    sink = JdbcSink(url, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    lb = spark.createDataFrame([(dt.datetime(2024, 1, 1), "t1", "n", "A", 3)],
                               "window_start_time timestamp_ntz, track_uri string, track_name string, "
                               "artist_name string, play_count int")
    sink.write(conform(lb, "realtime_leaderboard"), "LEADERBOARD", batch_id=1)
    sink.write(conform(lb, "realtime_leaderboard"), "LEADERBOARD", batch_id=2)
    sink.write(conform(lb, "realtime_leaderboard"), "LEADERBOARD", batch_id=2)      # the batch's retry replaces it
    back = sink.read(spark, "LEADERBOARD")
    assert back.count() == 2 and back.agg(F.sum("PLAY_COUNT" if "PLAY_COUNT" in back.columns
                                                else "play_count")).first()[0] == 6


def test_progress_rows_to_sink(spark, scratch):
    p = {"timestamp": "2024-01-01T10:00:00.123Z", "batchId": 3, "numInputRows": 50,
         "inputRowsPerSecond": 24.6, "processedRowsPerSecond": 99.0, "id": "q", "runId": "r", "durationMs": {"triggerExecution": 2032}}
    r = progress_row(p)
    assert (r["events_per_second"], r["spark_processing_delay_ms"], r["batch_id"]) == (25, 2032, 3)
    import json
    sink = TableSink(scratch)
    rec = ProgressRecorder(spark, sink)
    for x in (p, dict(p, batchId=4, numInputRows=0), dict(p, id="other")):
        rec.record(json.dumps(x))
    assert rec.flush() == 3
    rows = sink.read(spark, "system_metrics").collect()
    assert sorted((x.query_id, x.batch_id, x.events_per_second) for x in rows) == [("other", 3, 25), ("q", 3, 25)]


def test_table_create_and_recreate(spark, scratch):
    sink = TableSink(scratch)
    assert sink.create(spark, "albums")
    assert not sink.create(spark, "albums")
    rows = spark.createDataFrame([("al", "A", 1999)], "album_name string, artist_name string, year int")
    sink.write(conform(rows, "albums"), "albums")
    assert sink.read(spark, "albums").count() == 1
    sink.recreate(spark, "albums")
    assert sink.read(spark, "albums").count() == 0


def test_refresh_dimensions(spark, scratch):
    from cadence.plans.refresh import refresh_dimensions
    w = Workload(spark, SF_SMALL)
    sink = TableSink(scratch)
    refresh_dimensions(sink, w.enriched, w.clean_catalog)
    tracks = sink.read(spark, "tracks")
    rejects = spark.read.parquet(sink.path("tracks_rejects"))
    assert tracks.count() + rejects.count() == w.clean_catalog.count()
    assert tracks.where(F.col("track_name").isNull()).count() == 0
    assert str(tracks.schema["tempo"].dataType) == "DecimalType(7,3)"
    artists = sink.read(spark, "artists")
    assert artists.count() == w.artists.count()
    assert artists.agg(F.sum("total_play_count")).first()[0] == w.enriched.where(
        F.col("artist_name").isin([r.artist for r in w.artists.collect()])).count()
    g = sink.read(spark, "global_fallback_metrics").first()
    assert g.name == "Others"


def test_kafka_needs_only_the_connector(spark):
    """S1/S4 are option pass-throughs; here they stop at the data-source lookup (no jar, nothing opened)."""
    import pytest
    from pyspark.errors import AnalysisException

    from cadence.sources.kafka import publish_logs, read_log_stream
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_log_stream(spark, "broker:9092", "logs", min_partitions=4)
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        publish_logs(spark.createDataFrame([("x",)], "ts string"), "broker:9092", "logs")


def test_jdbc_missing_table_reads_empty(spark):
    from cadence.plans.dashboard import dashboard
    sink = JdbcSink("jdbc:derby:memory:cadence_empty;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert sink.read(spark, "realtime_leaderboard").count() == 0
    assert dashboard(spark, sink, minutes=None)["kpi"].first().total_events == 0


def test_json_store_round_trip(spark, scratch):
    w = Workload(spark, SF_SMALL)
    write_feature_store(w.tracks, w.artists, w.global_row, scratch, fmt="json")
    assert store_exists(spark, scratch)
    tracks, artists, glob = load_feature_store(spark, scratch)
    assert sorted((r.id, r.energy) for r in tracks.collect()) == sorted((r.id, r.energy) for r in w.tracks.collect())
    assert artists.count() == w.artists.count() and glob.count() == 1
    odd = spark.createDataFrame([("track:x", '{"energy": 0.5, "tempo": "fast"}'), ("track:y", "junk")], "key string, value string")
    got = {r.id: (r.energy, r.tempo, r.year) for r in features_of_json(odd)[0].collect()}
    assert got == {"x": (0.5, 0.0, 0.0), "y": (0.0, 0.0, 0.0)}


def test_contracts_bound_texts(spark):
    rows = [("a" * 255, 1), ("日" * 255, 1), ("a" * 256, 2), (None, 3)]
    df = spark.createDataFrame(rows, "track_uri string, skip_count int").withColumn("window_start_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    ok, broken = split_violations(conform(df, "engagement_metrics"), "engagement_metrics")
    assert sorted(r["skip_count"] for r in ok.collect()) == [1, 1, 3]
    assert broken.select(violation("engagement_metrics", broken.columns)).collect() == [(LONG_REASON,)]
    both = broken.withColumn("window_start_time", F.lit(None).cast("timestamp_ntz"))
    assert both.select(violation("engagement_metrics", both.columns)).first()[0] == NULL_REASON
    names = spark.createDataFrame([("x" * 51,), ("x" * 50,)], "name string")
    assert [len(r["name"]) for r in split_violations(conform(names, "global_fallback_metrics"), "global_fallback_metrics")[0].collect()] == [50]
    long = spark.createDataFrame([("x" * 5000, "why")], "raw string, reason string")
    assert split_violations(long, "quarantine")[1].isEmpty()
