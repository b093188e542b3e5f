"""SURVEY §5 invariants on the fixture data (sf0.001), through the registered queries."""

from pyspark.sql import functions as F

from __spark_entry__ import queries

from .conftest import SF_SMALL


def _q(spark, name):
    return queries()[name](spark, SF_SMALL)


def test_engagement_counts_add_up_to_plays(spark):
    eng = _q(spark, "engagement").select("track_uri", (F.col("skip_count") + F.col("natural_end_count")).alias("n"))
    lb = _q(spark, "leaderboard").select("track_uri", "play_count")
    assert eng.join(lb, "track_uri").where(F.col("n") != F.col("play_count")).count() == 0
    assert eng.count() == lb.count()


def test_tiers_and_totals(spark):
    tiers = {r.tier: r.total_events for r in _q(spark, "kpi_by_tier").collect()}
    total = _q(spark, "kpi").first().total_events
    assert sum(tiers.values()) == total == _q(spark, "enriched_events").count()
    cov = _q(spark, "coverage_exact").first()
    assert cov.track_logs + cov.artist_logs + cov.others_logs == cov.total_logs
    assert abs(cov.track_logs_pct + cov.artist_logs_pct + cov.others_pct - 100.0) < 0.02


def test_completion_bounds_and_grid(spark):
    e = _q(spark, "enriched_events")
    assert e.where((F.col("completion_rate") < 0) | (F.col("completion_rate") > 1)).count() == 0
    grid = _q(spark, "heatmap_grid")
    cells = grid.select(sum(F.col(f"h{h:02d}") for h in range(24)).alias("s")).agg(F.sum("s")).first()[0]
    assert cells == e.count()
    assert _q(spark, "heatmap").agg(F.sum("plays")).first()[0] == e.count()
