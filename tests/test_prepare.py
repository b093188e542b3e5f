"""Catalog/history cleaning, tiers, key checks, the keyed feature set, coverage."""

import pytest
from pyspark.sql import functions as F

from cadence.operators import coverage, prepare
from cadence.schemas import CATALOG_SCHEMA, RAW_HISTORY_SCHEMA


def _raw_history(spark, rows):
    return spark.createDataFrame(rows, RAW_HISTORY_SCHEMA)


def test_clean_history_rules(spark):
    raw = _raw_history(spark, [
        ("2024-01-01 10:00:00.75", 1234.9, "t1", "n", "a", "A", "TRUE", "false", None),
        ("2024-01-01 10:00:01", None, "t1", "n", "a", "A", None, "True", "x"),
        (None, 1.0, "t1", "n", "a", "A", "TRUE", "TRUE", None),           # no ts -> dropped
        ("2024-01-01 10:00:02", 1.0, None, "n", "a", "A", "TRUE", "TRUE", None),  # no uri -> dropped
        ("2024-01-01 10:00:03", 1.0, "t1", "n", "a", None, "TRUE", "TRUE", None),  # no artist -> dropped
        ("garbage", 1.0, "t1", "n", "a", "A", "TRUE", "TRUE", None),      # unreadable ts -> dropped
    ])
    out = prepare.clean_history(raw).collect()
    assert len(out) == 2
    assert (out[0].ts, out[0].ms_played, out[0].shuffle, out[0].skipped) == ("2024-01-01 10:00:00", 1234, True, False)
    assert (out[1].ms_played, out[1].shuffle, out[1].skipped) == (0, False, True)


def _cat_row(i, artists, **kw):
    vals = dict(valence=0.1, energy=0.2, danceability=0.3, acousticness=0.4, instrumentalness=0.5, liveness=0.6,
                loudness=-5.0, speechiness=0.05, tempo=120.0, popularity=50, duration_ms=200000, explicit=0,
                year=2000) | kw
    return (f"t{i}", artists) + tuple(vals[f.name] for f in CATALOG_SCHEMA.fields[2:])


def test_clean_catalog_drops_any_null_and_nan(spark):
    cat = spark.createDataFrame([_cat_row(1, "['A']"), _cat_row(2, "['B']", tempo=float("nan")),
                                 _cat_row(3, None), _cat_row(4, "['C']", year=None)], CATALOG_SCHEMA)
    assert [r.id for r in prepare.clean_catalog(cat).collect()] == ["t1"]


def test_duplicate_keys_and_assert_unique(spark):
    cat = spark.createDataFrame([_cat_row(1, "['A']"), _cat_row(1, "['B']"), _cat_row(2, "['C']")], CATALOG_SCHEMA)
    d = prepare.duplicate_keys(cat, "id").collect()
    assert [(r.id, r.n) for r in d] == [("t1", 2)]
    with pytest.raises(prepare.DuplicateKeyError):
        prepare.assert_unique(cat, "id")


def test_orphans(spark):
    child = spark.createDataFrame([("x", "A"), ("y", "Z"), ("z", None)], "k string, artist_name string")
    parent = spark.createDataFrame([("A",)], "artist_name string")
    assert [r.k for r in prepare.orphans(child, parent, "artist_name").collect()] == ["y"]


def test_feature_keys_union(spark):
    cat = spark.createDataFrame([_cat_row(1, "['A']"), _cat_row(2, "['A', 'B']")], CATALOG_SCHEMA)
    keys = prepare.feature_keys(*prepare.feature_tiers(cat))
    got = sorted(r.key for r in keys.collect())
    assert got == ["artist:A", "global:OTHERS", "track:t1", "track:t2"]


def test_coverage_report_counts(spark):
    cat = spark.createDataFrame([_cat_row(1, "['Ann']"), _cat_row(2, "[' Bob ']")], CATALOG_SCHEMA)
    hist = _raw_history(spark, [
        ("2024-01-01 00:00:00", 1.0, "t1", "n", "a", "X", None, None, None),     # track
        ("2024-01-01 00:00:00", 1.0, "t1", "n", "a", "X", None, None, None),     # track
        ("2024-01-01 00:00:00", 1.0, "t9", "n", "a", " ann ", None, None, None),  # artist (normalised)
        ("2024-01-01 00:00:00", 1.0, None, "n", "a", "BOB", None, None, None),   # artist, no uri
        ("2024-01-01 00:00:00", 1.0, "t8", "n", "a", "Cy", None, None, None),    # others
    ])
    r = coverage.coverage_report(hist, cat).first()
    assert (r.distinct_tracks, r.matched_tracks, r.track_match_pct) == (3, 1, 33.33)
    assert (r.total_logs, r.track_logs, r.artist_logs, r.others_logs) == (5, 2, 2, 1)
    assert (r.track_logs_pct, r.artist_logs_pct, r.others_pct, r.coverage_pct) == (40.0, 40.0, 20.0, 80.0)
    exact = coverage.coverage_report(hist, cat, normalize=False).first()
    assert exact.artist_logs == 0
    assert [x.track_uri for x in coverage.known_tracks(hist, cat).collect()] == ["t1"]
    assert coverage.unmatched_logs(hist, cat).count() == 3
    assert coverage.matched_logs(hist, cat).count() == 2


def test_coverage_report_empty(spark):
    cat = spark.createDataFrame([], CATALOG_SCHEMA)
    r = coverage.coverage_report(_raw_history(spark, []), cat).first()
    assert r.total_logs == 0 and r.coverage_pct is None and r.track_match_pct is None


def test_artist_means_round_half_even(spark):
    cat = spark.createDataFrame([_cat_row(1, "['A']", valence=0.1234), _cat_row(2, "['A']", valence=0.1235)],
                                CATALOG_SCHEMA)
    a = prepare.artist_features(prepare.clean_catalog(cat)).first()
    assert a.valence == 0.1234   # mean 0.12345 -> half-even
    assert prepare.global_features(prepare.clean_catalog(cat)).select(F.col("valence")).first()[0] == 0.1234


def test_odd_play_times_do_not_stop_the_job(spark):
    rows = [("2024-01-01 10:00:00", x, "t1", "n", "a", "A", "TRUE", "false", None) for x in (float("nan"), 1e12, float("inf"), -5.9, None, 7.9)]
    assert [r.ms_played for r in prepare.clean_history(_raw_history(spark, rows)).collect()] == [0, 0, 0, -5, 0, 7]
