"""Tiered enrichment (J1, J2) and the quarantine split (P15) on hand-made rows."""

from pyspark.sql import functions as F

from cadence.operators import prepare
from cadence.operators.enrich import enrich, split_quarantine
from cadence.schemas import CATALOG_SCHEMA, LOG_SCHEMA


def _catalog(spark):
    base = dict(valence=0.1, energy=0.2, danceability=0.3, acousticness=0.4, instrumentalness=0.5, liveness=0.6,
                loudness=-5.0, speechiness=0.05, tempo=120.0, popularity=50, duration_ms=200000, explicit=0,
                year=2000)
    rows = [
        dict(base, id="t1", artists="['Ann', 'x']", energy=0.9, duration_ms=100000, year=1990),
        dict(base, id="t2", artists="['Ann']", energy=0.5, duration_ms=300000, year=2001),
        dict(base, id="t3", artists="['Bob']", energy=0.1, duration_ms=200000, year=2010),
    ]
    return spark.createDataFrame([tuple(r[f.name] for f in CATALOG_SCHEMA.fields) for r in rows], CATALOG_SCHEMA)


def _logs(spark, rows):
    full = [dict(ts="2024-01-01 10:00:00", ms_played=50000, spotify_track_uri=None, track_name="n",
                 album_name="al", artist_name=None, shuffle=False, skipped=False, reason_end=None) | r for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in LOG_SCHEMA.fields) for r in full], LOG_SCHEMA)


def test_tiers_take_whole_rows(spark):
    tracks, artists, glob = prepare.feature_tiers(_catalog(spark))
    logs = _logs(spark, [
        dict(spotify_track_uri="t1", artist_name="Bob"),      # track tier wins over a known artist
        dict(spotify_track_uri="zz", artist_name="Ann"),      # artist tier: mean of t1, t2
        dict(spotify_track_uri="zz", artist_name="Nobody"),   # global tier: mean of all
        dict(spotify_track_uri=None, artist_name=None),       # null keys never match
    ])
    out = enrich(logs, tracks, artists, glob, with_tier=True).collect()
    assert [r.tier for r in out] == ["track", "artist", "others", "others"]
    assert out[0].energy == 0.9 and out[0].duration_ms == 100000 and out[0].year == 1990
    assert out[0].completion_rate == 0.5
    assert out[1].energy == 0.7 and out[1].duration_ms == 200000 and out[1].year == 1995
    assert out[2].energy == 0.5 and out[2].duration_ms == 200000 and out[2].year == 2000
    assert out[1].completion_rate == 0.25


def test_empty_store_gives_zeros(spark):
    empty = _catalog(spark).limit(0)
    tracks, artists, glob = prepare.feature_tiers(empty)
    logs = _logs(spark, [dict(spotify_track_uri="t1", artist_name="Ann", ms_played=None)])
    r = enrich(logs, tracks, artists, glob, with_tier=True).first()
    assert (r.energy, r.valence, r.duration_ms, r.year, r.completion_rate, r.ms_played) == (0.0, 0.0, 0, 0, 0.0, 0)


def test_derived_fields(spark):
    tracks, artists, glob = prepare.feature_tiers(_catalog(spark))
    logs = _logs(spark, [dict(spotify_track_uri="t3", ts="2024-01-07 23:15:00", ms_played=400000,
                              reason_end="fwdSkip")])
    r = enrich(logs, tracks, artists, glob).first()
    assert (r.completion_rate, r.is_skip, r.hour_of_day, r.day_of_week) == (1.0, True, 23, 7)


def test_quarantine_split(spark):
    logs = _logs(spark, [dict(ts="2024-01-01 00:00:00"), dict(ts="bad"), dict(ts=None)])
    valid, bad = split_quarantine(logs)
    assert valid.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["missing ts", "unreadable ts"]


def test_no_python_udf_and_artist_broadcast(spark):
    tracks, artists, glob = prepare.feature_tiers(_catalog(spark))
    logs = _logs(spark, [dict(spotify_track_uri="t1", artist_name="Ann")])
    plan = enrich(logs, tracks, artists, glob)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "EvalPython" not in plan
    assert "Broadcast" in plan


def test_artist_tier_over_limit_is_not_hinted(spark):
    tracks, artists, glob = prepare.feature_tiers(_catalog(spark))
    logs = _logs(spark, [dict(spotify_track_uri="t1", artist_name="Ann")])
    e = enrich(logs, tracks, artists, glob, artist_broadcast_bytes=1)
    assert e.where(F.col("energy") == 0.9).count() == 1
