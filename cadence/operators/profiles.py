"""Dimension tables the result schema declares (D1-D4): artists, tracks, albums,
and the global fallback row.

Each profile joins a catalog aggregate with a play aggregate on the
dimension key. Both sides are aggregated (partially, map-side) before the
join, so the join sees one row per key on each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions import clip, ratio, round4
from cadence.operators.metrics import FIRST_AT, earliest, first_seen

# Features the artist and global-fallback tables average (every catalog feature but year).
PROFILE_FEATURES = ["popularity", "explicit", "danceability", "energy", "loudness", "speechiness",
                    "acousticness", "instrumentalness", "liveness", "valence", "tempo"]
FALLBACK_FEATURES = ["danceability", "energy", "loudness", "speechiness", "acousticness",
                     "instrumentalness", "liveness", "valence", "tempo"]
TRACK_FEATURES = ["danceability", "energy", "loudness", "speechiness", "acousticness",
                  "instrumentalness", "liveness", "valence", "tempo"]
TRACK_NAMES, ALBUM_NAMES = ["track_name", "album_name"], ["artist_name", "year"]
PLAY_TOTALS = ["total_play_count", "total_skip_count", "total_listening_time_ms", "avg_listening_time_ms"]


_SUMS = ["_n", "_skips", "_ms", "_with_ms", "_completion"]


def _play_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col("is_skip"), 1).otherwise(0)).alias("_skips"),
        F.sum(F.col("ms_played").cast("long")).alias("_ms"),
        F.count("ms_played").alias("_with_ms"),
        F.sum("completion_rate").alias("_completion"),
    ]


def play_totals(events: DataFrame, key: str, names: list[str] | None = None) -> DataFrame:
    """Per ``key``: plays, skips, listening time and likeability; ``names`` adds their first-seen values (``_first``).

    Two steps, both hash aggregates over fixed-width buffers up to the few rows of a key.
    """
    names = names or []
    return merged_totals(earliest(events, [key], names, *_play_sums()), key, names)


def merged_totals(states: DataFrame, key: str, names: list[str] | None = None) -> DataFrame:
    """The second step of :func:`play_totals`, over partial states however finely they are grouped."""
    names = names or []
    n, skips = F.sum("_n"), F.sum("_skips")
    return states.groupBy(key).agg(
        *([first_seen(*names, order=FIRST_AT).alias("_first")] if names else []),
        n.alias("total_play_count"),
        skips.alias("total_skip_count"),
        F.sum("_ms").alias("total_listening_time_ms"),
        (F.sum("_ms").cast("double") / F.nullif(F.sum("_with_ms"), F.lit(0))).cast("long").alias("avg_listening_time_ms"),
        round4(clip(F.sum("_completion").cast("double") / n - ratio(skips, n))).alias("likeability_score"),
    )


# Grouping of the partial states that all three dimensions can be merged from, and the states' columns.
STATE_KEYS = ["track_uri", "track_name", "album_name", "artist_name", "year"]
STATE_SCHEMA = ("track_uri string, track_name string, album_name string, artist_name string, year int, "
                f"{FIRST_AT} timestamp_ntz, _n long, _skips long, _ms long, _with_ms long, _completion decimal(30,4)")


def _as_states(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in (f.split(" ") for f in STATE_SCHEMA.split(", "))])


def play_states(events: DataFrame) -> DataFrame:
    """Partial states of the plays of an events table: sums and the earliest time per track, names and year.

    Completion is summed as the four places that the table stores, so that the order of merging changes nothing.
    """
    return _as_states(earliest(events, STATE_KEYS, [], *_play_sums()))


def merge_states(states: DataFrame) -> DataFrame:
    """States of the same track, names and year made one."""
    return _as_states(states.groupBy(*STATE_KEYS).agg(F.min(FIRST_AT).alias(FIRST_AT), *[F.sum(c).alias(c) for c in _SUMS]))


def _fill_totals(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) if c in PLAY_TOTALS else F.col(c)
                       for c in df.columns])


def artist_profile(events: DataFrame, clean_catalog: DataFrame) -> DataFrame:
    """Catalog feature means per artist, with the artist's play totals (0 when never played)."""
    return _artists(clean_catalog, play_totals(events.where(F.col("artist_name").isNotNull()), "artist_name"))


def artists_of_states(states: DataFrame, clean_catalog: DataFrame) -> DataFrame:
    """D1 from partial states."""
    return _artists(clean_catalog, merged_totals(states.where(F.col("artist_name").isNotNull()), "artist_name"))


def _artists(clean_catalog: DataFrame, plays: DataFrame) -> DataFrame:
    cat = clean_catalog.where(F.col("artist").isNotNull()).groupBy(F.col("artist").alias("artist_name")).agg(
        F.avg("duration_ms").cast("long").alias("avg_duration_ms"),
        *[round4(F.avg(f)).alias(f"avg_{f}") for f in PROFILE_FEATURES],
    )
    return _fill_totals(cat.join(plays, "artist_name", "left"))


def track_profile(events: DataFrame, clean_catalog: DataFrame) -> DataFrame:
    """Per catalog track: names (first play), catalog features and play totals."""
    return _tracks(clean_catalog, play_totals(events.where(F.col("track_uri").isNotNull()), "track_uri", TRACK_NAMES))


def tracks_of_states(states: DataFrame, clean_catalog: DataFrame) -> DataFrame:
    """D2 from partial states."""
    return _tracks(clean_catalog, merged_totals(states.where(F.col("track_uri").isNotNull()), "track_uri", TRACK_NAMES))


def _tracks(clean_catalog: DataFrame, plays: DataFrame) -> DataFrame:
    cat = clean_catalog.select(
        F.col("id").alias("track_uri"), F.col("artist").alias("artist_name"),
        "duration_ms", "explicit", "popularity", "year",
        *[round4(f).alias(f) for f in TRACK_FEATURES],
    )
    j = cat.join(plays, "track_uri", "left")
    cols = ["track_uri", F.col("_first.track_name").alias("track_name"),
            F.col("_first.album_name").alias("album_name"), "artist_name", "duration_ms", "explicit",
            "popularity", "year", *TRACK_FEATURES, *PLAY_TOTALS, "likeability_score"]
    return _fill_totals(j.select(*cols))


def album_dim(events: DataFrame) -> DataFrame:
    """D3: per album: artist and release year of its first play."""
    return _albums(earliest(events.where(F.col("album_name").isNotNull()), ["album_name"], ALBUM_NAMES))


def albums_of_states(states: DataFrame) -> DataFrame:
    """D3 from partial states."""
    return _albums(earliest(states.where(F.col("album_name").isNotNull()), ["album_name"], ALBUM_NAMES, order=FIRST_AT))


def _albums(few: DataFrame) -> DataFrame:
    g = few.groupBy("album_name").agg(first_seen(*ALBUM_NAMES, order=FIRST_AT).alias("_first"))
    return g.select("album_name", F.col("_first.artist_name").alias("artist_name"),
                    F.col("_first.year").alias("year"))


def global_fallback(clean_catalog: DataFrame, name: str = "Others") -> DataFrame:
    """The global fallback row, named ``name``."""
    return clean_catalog.agg(
        F.avg("duration_ms").cast("long").alias("avg_duration_ms"),
        *[round4(F.avg(f)).alias(f"avg_{f}") for f in FALLBACK_FEATURES],
    ).select(F.lit(name).alias("name"), "*")
