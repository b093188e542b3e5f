"""Incremental refresh of the dimensions: equal to the full refresh after every step, reading new batches only."""

import os

import pytest
from pyspark.sql import functions as F

from cadence.operators import profiles
from cadence.plans.dashboard import as_doubles
from cadence.plans.increments import EVENTS, STATES, IncrementalDimensions
from cadence.plans.refresh import refresh_dimensions
from cadence.sources.commits import CommitLog, CommittedSink
from cadence.sources.sinks import TableSink, conform

CATALOG = "id string, artist string, " + ", ".join(f"{c} double" for c in [
    "valence", "energy", "danceability", "acousticness", "instrumentalness", "liveness", "loudness", "speechiness", "tempo"]) + \
    ", popularity int, duration_ms long, explicit int, year int"
TABLES = ["artists", "tracks", "albums", "global_fallback_metrics"]


@pytest.fixture()
def catalog(spark):
    return spark.createDataFrame([(t, a, *[0.5] * 9, 10, 1000, 0, 2000) for t, a in [("t1", "A"), ("t2", "A"), ("t3", "B"), ("t4", "C")]], CATALOG)


def plays(spark, rows):
    """Plays (second, track, track name, album, artist, completion, skipped)."""
    df = spark.createDataFrame([(f"2024-01-0{1 + s // 100} 00:00:{s % 60:02d}", t, n, al, ar, c, sk) for s, t, n, al, ar, c, sk in rows],
                               "timestamp string, track_uri string, track_name string, album_name string, artist_name string, "
                               "completion_rate double, is_skip boolean")
    return conform(df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
                     .withColumns({"ms_played": F.lit(7), "year": F.lit(2001), "duration_ms": F.lit(1000).cast("long"), "hour_of_day": F.lit(0),
                                   "day_of_week": F.lit(1), **{c: F.lit(0.5) for c in ("energy", "valence", "danceability", "acousticness")}}), EVENTS)


def commit(spark, sink, batch, rows):
    sink.write(plays(spark, rows), EVENTS, batch)
    sink.commit(spark, batch)


def same_as_full(spark, sink, catalog, scratch, step):
    full, inc = TableSink(os.path.join(scratch, f"full-{step}")), IncrementalDimensions(sink, merge_at=2)
    read = inc.advance(spark)
    got = {"artists": profiles.artists_of_states(inc.states(spark), catalog), "tracks": profiles.tracks_of_states(inc.states(spark), catalog),
           "albums": profiles.albums_of_states(inc.states(spark)), "global_fallback_metrics": profiles.global_fallback(catalog)}
    want = refresh_dimensions(full, as_doubles(sink.read(spark, EVENTS)), catalog)
    for name in TABLES:
        mine = conform(got[name], name)
        mine = mine.where("track_name is not null") if name == "tracks" else mine
        assert sorted(map(str, mine.collect())) == sorted(map(str, want[name].collect())), (step, name)
    return read


def test_every_step_equals_the_full_refresh(spark, scratch, catalog):
    sink = CommittedSink(os.path.join(scratch, "tables"))
    assert same_as_full(spark, sink, catalog, scratch, "empty") == []
    commit(spark, sink, 0, [(5, "t1", "late name", "x", "A", 0.1234, False), (9, None, "n", None, None, 1.0, True)])
    assert same_as_full(spark, sink, catalog, scratch, "first") == [0]
    assert same_as_full(spark, sink, catalog, scratch, "again") == []
    commit(spark, sink, 1, [(1, "t1", "early name", "y", "B", 0.5, True), (2, "t3", "c", "y", "B", 0.25, False)])
    assert same_as_full(spark, sink, catalog, scratch, "second") == [1]
    # the second batch is committed again without its early play: its earliest time must go, too
    commit(spark, sink, 1, [(2, "t3", "c", "y", "B", 0.75, False), (2, "t3", "c", "y", "B", 0.75, False)])
    assert same_as_full(spark, sink, catalog, scratch, "replaced") == [1]
    commit(spark, sink, 2, [])
    commit(spark, sink, 3, [(101, "t2", "d", "z", "A", 1.0, False)])
    sink.compact(spark, [EVENTS])
    assert same_as_full(spark, sink, catalog, scratch, "merged") == [2, 3]
    inc = IncrementalDimensions(sink, merge_at=2)
    snapshot = CommitLog(spark, inc.root).snapshot()
    assert snapshot.merged_batches == {0, 1, 2} and len(snapshot.of(STATES)) == 2  # a base, and the batch that may be replaced
    assert inc.expire(spark) > 0 and inc.expire(spark) == 0
    sink.expire(spark)
    assert same_as_full(spark, sink, catalog, scratch, "expired") == []
    commit(spark, sink, 3, [(102, "t2", "e", "z", "A", 0.5, True)])
    assert same_as_full(spark, sink, catalog, scratch, "last") == [3]


def test_commits_that_expired_are_read_from_the_days(spark, scratch, catalog):
    sink = CommittedSink(os.path.join(scratch, "tables"))
    commit(spark, sink, 0, [(1, "t1", "a", "x", "A", 0.5, False)])
    assert same_as_full(spark, sink, catalog, scratch, 0) == [0]
    # tried again, merged and its commits dropped before the next advance: the state of the first try must not stay
    commit(spark, sink, 0, [(1, "t1", "b", "x", "A", 0.25, True)])
    for k in (1, 2):
        commit(spark, sink, k, [(k + 1, "t4", "c", "w", "C", 0.5, False)])
    sink.compact(spark, [EVENTS])
    sink.expire(spark)
    assert same_as_full(spark, sink, catalog, scratch, 1) == [0, 1, 2]
    assert same_as_full(spark, sink, catalog, scratch, 2) == []


def test_a_retry_merged_between_two_advances_is_read_again(spark, scratch, catalog):
    sink = CommittedSink(os.path.join(scratch, "tables"))
    commit(spark, sink, 0, [(1, "t1", "a", "x", "A", 0.5, False)])
    commit(spark, sink, 1, [(2, "t1", "a", "x", "A", 0.5, False)])
    assert same_as_full(spark, sink, catalog, scratch, 0) == [0, 1]
    commit(spark, sink, 0, [(3, "t2", "b", "x", "A", 0.25, True)])
    sink.compact(spark, [EVENTS])
    assert same_as_full(spark, sink, catalog, scratch, 1) == [0]


def test_a_broken_advance_shows_nothing(spark, scratch, catalog, monkeypatch):
    sink = CommittedSink(os.path.join(scratch, "tables"))
    commit(spark, sink, 0, [(1, "t1", "a", "x", "A", 0.5, False)])
    inc = IncrementalDimensions(sink)
    monkeypatch.setattr(CommitLog, "commit", lambda self, plan: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        inc.advance(spark)
    monkeypatch.undo()
    assert inc.states(spark).count() == 0
    assert inc.advance(spark) == [0] and inc.states(spark).count() == 1
    written = inc.refresh(spark, catalog)
    assert sorted(written) == sorted(TABLES) and sink.read(spark, "tracks").first().track_name == "a"
