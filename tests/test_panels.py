"""Panel and metric operators on hand-made enriched rows (known answers and invariants)."""

import datetime as dt

from pyspark.sql import functions as F

from cadence.operators import metrics, panels
from cadence.schemas import ENRICHED_SCHEMA


def _events(spark, rows):
    base = dict(timestamp=dt.datetime(2024, 1, 1, 0, 0, 0), track_uri="t1", track_name="n", album_name="al",
                artist_name="A", ms_played=1000, energy=0.5, valence=0.5, danceability=0.5, acousticness=0.5,
                duration_ms=1000, year=2000, completion_rate=1.0, is_skip=False, hour_of_day=0, day_of_week=1)
    full = [base | r for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in ENRICHED_SCHEMA.fields) for r in full], ENRICHED_SCHEMA)


def test_likeability_bounds(spark):
    ev = _events(spark, [dict(artist_name="skipper", is_skip=True, completion_rate=0.0)] * 3
                 + [dict(artist_name="keeper", is_skip=False, completion_rate=1.0)] * 2)
    got = {r.artist_name: r.likeability for r in panels.likeability(ev, minutes=None).collect()}
    assert got == {"skipper": -1.0, "keeper": 1.0}


def test_current_rate_ignores_empty_seconds(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    secs = [0] * 4 + [1] * 2 + [3] * 6
    ev = _events(spark, [dict(timestamp=t0 + dt.timedelta(seconds=s)) for s in secs])
    eps = panels.events_per_second(ev, minutes=None)
    assert [r.events for r in eps.collect()] == [4, 2, 6]
    assert panels.current_rate(eps).first().current_rate == 4.0


def test_current_rate_empty_is_zero(spark):
    ev = _events(spark, []).limit(0)
    assert panels.current_rate(panels.events_per_second(ev, minutes=None)).first().current_rate == 0.0


def test_kpi_on_no_rows(spark):
    r = panels.kpi(_events(spark, []).limit(0), minutes=None).first()
    assert r.total_events == 0 and r.avg_valence is None and r.skip_rate is None


def test_dense_grid(spark):
    g = panels.heatmap_grid(_events(spark, [dict(day_of_week=1, hour_of_day=0)]), minutes=None).collect()
    cells = [c for r in g for c in r[2:]]
    assert len(g) == 7 and len(cells) == 168 and sum(cells) == 1 and g[0].h00 == 1


def test_lookback_anchor(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    ev = _events(spark, [dict(timestamp=t0 - dt.timedelta(minutes=m)) for m in (0, 10, 29, 31, 90)])
    as_of = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    assert panels.kpi(ev, minutes=30, as_of=as_of).first().total_events == 3


def test_engagement_invariant(spark):
    ev = _events(spark, [dict(track_uri=f"t{i % 3}", is_skip=i % 2 == 0) for i in range(11)])
    out = metrics.engagement(ev).collect()
    lb = {r.track_uri: r.play_count for r in metrics.leaderboard(ev).collect()}
    for r in out:
        assert r.skip_count + r.natural_end_count == lb[r.track_uri]


def test_leaderboard_first_seen_name(spark):
    t0 = dt.datetime(2024, 1, 1)
    ev = _events(spark, [dict(track_name="later", timestamp=t0 + dt.timedelta(seconds=5)),
                         dict(track_name="earliest", timestamp=t0)])
    assert metrics.leaderboard(ev).first().track_name == "earliest"


def test_top_tracks_merges_partials(spark):
    lb = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "t1", "a", "A", 2), (dt.datetime(2024, 1, 2), "t1", "a", "A", 3),
         (dt.datetime(2024, 1, 2), "t2", "b", "B", 4)],
        "window_start_time timestamp_ntz, track_uri string, track_name string, artist_name string, play_count int")
    got = [(r.track_name, r.plays) for r in panels.top_tracks(lb, minutes=None, n=5).collect()]
    assert got == [("a", 5), ("b", 4)]


def test_mood_sample_modes(spark):
    t0 = dt.datetime(2024, 1, 1)
    ev = _events(spark, [dict(timestamp=t0 + dt.timedelta(seconds=i)) for i in range(50)])
    assert metrics.mood_sample(ev, n=10, mode="limit").count() == 10
    newest = metrics.mood_sample(ev, n=3, mode="newest").collect()
    assert [r.timestamp.second for r in newest] == [49, 48, 47]
    a = metrics.mood_sample(ev, n=7, mode="hash").collect()
    assert a == metrics.mood_sample(ev, n=7, mode="hash").collect()


def test_windowed_mood_weights(spark):
    t0 = dt.datetime(2024, 1, 1)
    ev = _events(spark, [dict(timestamp=t0, valence=1.0), dict(timestamp=t0, valence=0.0),
                         dict(timestamp=t0 + dt.timedelta(minutes=15), valence=0.4)])
    rows = metrics.windowed_mood(ev, "10 minutes").orderBy("window_start_time").collect()
    assert [(r.total_streams, r.avg_valence) for r in rows] == [(2, 0.5), (1, 0.4)]
