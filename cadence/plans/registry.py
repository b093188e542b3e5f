"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each one reads the whole test tables of ``sf_dir`` (through
:class:`Workload`) and returns the operator's result. Doubles are shown
rounded to six places (:func:`present`) so that engines that add in a
different order report the same value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions import present
from cadence.operators import coverage, metrics, panels, prepare, profiles
from cadence.plans.workload import Workload
from cadence.schemas import ENRICHED_COLUMNS
from cadence.session import run_folder
from cadence.sources.files import load_feature_store, write_feature_store

Query = Callable[[SparkSession, str], DataFrame]

# Panel parameters used by the registered queries.
RECENT_MINUTES = 240           # the widest lookback the dashboard offers
TIMELINE_WINDOW = "1 hour"     # event-time window standing in for one micro-batch row
MOOD_WINDOW = "10 minutes"


def show(df: DataFrame) -> DataFrame:
    """Round every double column for reporting."""
    return df.select(*[present(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _q(fn: Callable[[Workload], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return show(fn(Workload.of(spark, sf_dir)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def enriched_events(w: Workload) -> DataFrame:
    """Every cleaned play with the features of its tier."""
    return w.enriched.select(*ENRICHED_COLUMNS)


def match_tiers(w: Workload) -> DataFrame:
    """The tier that enriched each play."""
    return w.enriched_tiered.select("timestamp", "track_uri", "artist_name", "tier")


def clean_catalog(w: Workload) -> DataFrame:
    return w.clean_catalog


def clean_history(w: Workload) -> DataFrame:
    return w.history


def track_features(w: Workload) -> DataFrame:
    return w.tracks


def artist_features(w: Workload) -> DataFrame:
    return w.artists


def global_features(w: Workload) -> DataFrame:
    return w.global_row


def feature_keys(w: Workload) -> DataFrame:
    return prepare.feature_keys(w.tracks, w.artists, w.global_row)


def duplicate_keys(w: Workload) -> DataFrame:
    """Q1: track uris that occur more than once in the cleaned history, with their count."""
    return prepare.duplicate_keys(w.history, "spotify_track_uri")


def catalog_id_duplicates(w: Workload) -> DataFrame:
    """Q1: the uniqueness check the track tier needs (empty when the catalog is sound)."""
    return prepare.duplicate_keys(w.clean_catalog, "id")


def orphans(w: Workload) -> DataFrame:
    """Plays whose artist has no row in the artist dimension (foreign-key check)."""
    plays = w.enriched.select("timestamp", "track_uri", "artist_name")
    return prepare.orphans(plays, profiles.artist_profile(w.enriched, w.clean_catalog), "artist_name")


def orphans_tracks_albums(w: Workload) -> DataFrame:
    """Catalog tracks whose album has no row in the album dimension."""
    tracks = profiles.track_profile(w.enriched, w.clean_catalog).select("track_uri", "album_name")
    return prepare.orphans(tracks, profiles.album_dim(w.enriched), "album_name")


def orphans_albums_artists(w: Workload) -> DataFrame:
    """Albums whose artist has no row in the artist dimension."""
    return prepare.orphans(profiles.album_dim(w.enriched), profiles.artist_profile(w.enriched, w.clean_catalog), "artist_name")


def features_from_json(w: Workload) -> DataFrame:
    """F14 + S8: the three tiers, written as keyed JSON and read back, as one keyed set."""
    path = run_folder(w.spark, "json-store")
    write_feature_store(w.tracks, w.artists, w.global_row, path, fmt="json")
    return prepare.feature_keys(*load_feature_store(w.spark, path))


def coverage_report(w: Workload) -> DataFrame:
    return coverage.coverage_report(w.raw_history, w.catalog)


def known_tracks(w: Workload) -> DataFrame:
    return coverage.known_tracks(w.raw_history, w.catalog)


def unmatched_logs(w: Workload) -> DataFrame:
    """Raw plays whose track the catalog does not have."""
    return coverage.unmatched_logs(w.raw_history, w.catalog).select("event_id", "spotify_track_uri", "artist_name")


def matched_logs(w: Workload) -> DataFrame:
    """Raw plays whose track the catalog has (semi join)."""
    return coverage.matched_logs(w.raw_history, w.catalog).select("event_id", "spotify_track_uri", "artist_name")


def coverage_exact(w: Workload) -> DataFrame:
    """C1 with exact artist matching (the key the enrichment itself uses)."""
    return coverage.coverage_report(w.raw_history, w.catalog, normalize=False)


def distinct_artists(w: Workload) -> DataFrame:
    """The set of artist names in the cleaned history."""
    return coverage.distinct_ids(w.history, "artist_name")


def leaderboard(w: Workload) -> DataFrame:
    return metrics.leaderboard(w.enriched)


def mood_metrics(w: Workload) -> DataFrame:
    return metrics.mood_metrics(w.enriched)


def engagement(w: Workload) -> DataFrame:
    return metrics.engagement(w.enriched)


def mood_sample(w: Workload) -> DataFrame:
    return metrics.mood_sample(w.enriched, n=200, mode="newest")


def windowed_mood(w: Workload) -> DataFrame:
    return metrics.windowed_mood(w.enriched, MOOD_WINDOW)


def windowed_leaderboard(w: Workload) -> DataFrame:
    return metrics.windowed_leaderboard(w.enriched, MOOD_WINDOW)


def windowed_engagement(w: Workload) -> DataFrame:
    return metrics.windowed_engagement(w.enriched, MOOD_WINDOW)


def kpi(w: Workload) -> DataFrame:
    return panels.kpi(w.enriched, minutes=None)


def kpi_recent(w: Workload) -> DataFrame:
    """A7 + P8: the KPI row over the last four hours before the newest play."""
    return panels.kpi(w.enriched, minutes=RECENT_MINUTES, as_of=w.as_of)


def heatmap(w: Workload) -> DataFrame:
    return panels.heatmap(w.enriched, minutes=None)


def heatmap_grid(w: Workload) -> DataFrame:
    return panels.heatmap_grid(w.enriched, minutes=None)


def skip_profile(w: Workload) -> DataFrame:
    return panels.skip_profile(w.enriched, minutes=None)


def completion_by_hour(w: Workload) -> DataFrame:
    return panels.completion_by_hour(w.enriched, minutes=None)


def likeability(w: Workload) -> DataFrame:
    return panels.likeability(w.enriched, minutes=None, k=10)


def artist_engagement(w: Workload) -> DataFrame:
    """A12 before ranking: completion, skip rate, plays and likeability of every artist."""
    return panels.artist_engagement(w.enriched, minutes=None)


def nostalgia(w: Workload) -> DataFrame:
    return panels.nostalgia(w.enriched, minutes=None)


def top_tracks(w: Workload) -> DataFrame:
    """A14 + T1: hourly leaderboard rows merged into the ten most played tracks."""
    return panels.top_tracks(metrics.windowed_leaderboard(w.enriched, TIMELINE_WINDOW), minutes=None, n=10)


def top_tracks_recent(w: Workload) -> DataFrame:
    """A14 + T1 + P8: the ten most played tracks of the last four hours of hourly rows."""
    plays = panels.recent(w.enriched, "timestamp", RECENT_MINUTES, w.as_of)  # windows that start later hold no other play
    return panels.top_tracks(metrics.windowed_leaderboard(plays, TIMELINE_WINDOW), minutes=RECENT_MINUTES,
                             as_of=w.as_of, n=10)


def events_per_second_recent(w: Workload) -> DataFrame:
    """A15 + P9: plays per second in the two minutes before the newest play (the panel's default)."""
    return panels.events_per_second(w.enriched, as_of=w.as_of)


def events_per_second(w: Workload) -> DataFrame:
    return panels.events_per_second(w.enriched, minutes=None)


def current_rate(w: Workload) -> DataFrame:
    return panels.current_rate(panels.events_per_second(w.enriched, minutes=None))


def mood_timeline(w: Workload) -> DataFrame:
    return panels.mood_timeline(metrics.windowed_mood(w.enriched, TIMELINE_WINDOW), minutes=None)


def mood_timeline_recent(w: Workload) -> DataFrame:
    """T6 + P8: hourly mood rows of the last four hours before the newest play."""
    plays = panels.recent(w.enriched, "timestamp", RECENT_MINUTES, w.as_of)
    return panels.mood_timeline(metrics.windowed_mood(plays, TIMELINE_WINDOW), minutes=RECENT_MINUTES,
                                as_of=w.as_of)


def mood_scatter(w: Workload) -> DataFrame:
    return panels.mood_scatter(w.enriched.select(*metrics.SAMPLE_COLUMNS, "dt"), minutes=None, n=3000)


def mood_quadrants(w: Workload) -> DataFrame:
    return panels.mood_quadrants(w.enriched, minutes=None)


def artist_profile(w: Workload) -> DataFrame:
    return profiles.artist_profile(w.enriched, w.clean_catalog)


def track_profile(w: Workload) -> DataFrame:
    return profiles.track_profile(w.enriched, w.clean_catalog)


def album_dim(w: Workload) -> DataFrame:
    return profiles.album_dim(w.enriched)


def global_fallback(w: Workload) -> DataFrame:
    return profiles.global_fallback(w.clean_catalog)


_BATCH = [
    enriched_events, match_tiers, clean_catalog, clean_history, track_features, artist_features,
    global_features, feature_keys, duplicate_keys, catalog_id_duplicates, orphans, orphans_tracks_albums,
    orphans_albums_artists, features_from_json, coverage_report,
    coverage_exact, known_tracks, unmatched_logs, matched_logs, distinct_artists, leaderboard, mood_metrics,
    engagement, mood_sample, windowed_mood, windowed_leaderboard, windowed_engagement, kpi, kpi_recent, heatmap,
    heatmap_grid, skip_profile, completion_by_hour, artist_engagement, likeability, nostalgia, top_tracks,
    top_tracks_recent, events_per_second, events_per_second_recent, current_rate, mood_timeline,
    mood_timeline_recent, mood_scatter, mood_quadrants, artist_profile, track_profile, album_dim, global_fallback,
]


def batch_queries() -> dict[str, Query]:
    return {fn.__name__: _q(fn) for fn in _BATCH}
