"""Schemas and table contracts.

Every input and output has an explicit StructType; nothing is inferred.
Timestamps are wall-clock values without a zone (``timestamp_ntz``): the
log format carries local time as text and every derived field (hour,
weekday, per-second bucket) is taken from that wall clock, so results do
not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Catalog feature columns, in the order the reference lists them.
CATALOG_FEATURES = [
    "valence", "energy", "danceability", "acousticness",
    "instrumentalness", "liveness", "loudness", "speechiness",
    "tempo", "popularity", "duration_ms", "explicit", "year",
]
# Features the enrichment copies onto each play.
ENRICH_FEATURES = ["energy", "valence", "danceability", "acousticness", "duration_ms", "year"]
# History columns whose null value drops the row.
HISTORY_REQUIRED = ["ts", "spotify_track_uri", "artist_name"]
# Timestamp text format used by the log stream.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Key prefixes of the keyed feature set.
TRACK_PREFIX = "track:"
ARTIST_PREFIX = "artist:"
GLOBAL_KEY = "global:OTHERS"
# ---------------------------------------------------------------------------

_D = T.DoubleType()
_S = T.StringType()
_I = T.IntegerType()
_L = T.LongType()
_B = T.BooleanType()
_TS = T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CATALOG_SCHEMA = _struct(
    ("id", _S), ("artists", _S),
    ("valence", _D), ("energy", _D), ("danceability", _D), ("acousticness", _D),
    ("instrumentalness", _D), ("liveness", _D), ("loudness", _D), ("speechiness", _D),
    ("tempo", _D), ("popularity", _I), ("duration_ms", _L), ("explicit", _I), ("year", _I),
)

# Raw listening history as it arrives in CSV: loose types, cleaned by prepare.clean_history.
RAW_HISTORY_SCHEMA = _struct(
    ("ts", _S), ("ms_played", _D), ("spotify_track_uri", _S), ("track_name", _S),
    ("album_name", _S), ("artist_name", _S), ("shuffle", _S), ("skipped", _S), ("reason_end", _S),
)

# One log message on the stream (also the cleaned history row).
LOG_SCHEMA = _struct(
    ("ts", _S), ("ms_played", _I), ("spotify_track_uri", _S), ("track_name", _S),
    ("album_name", _S), ("artist_name", _S), ("shuffle", _B), ("skipped", _B), ("reason_end", _S),
)

ENRICHED_SCHEMA = _struct(
    ("timestamp", _TS), ("track_uri", _S), ("track_name", _S), ("album_name", _S),
    ("artist_name", _S), ("ms_played", _I), ("energy", _D), ("valence", _D),
    ("danceability", _D), ("acousticness", _D), ("duration_ms", _L), ("year", _I),
    ("completion_rate", _D), ("is_skip", _B), ("hour_of_day", _I), ("day_of_week", _I),
)
ENRICHED_COLUMNS = [f.name for f in ENRICHED_SCHEMA.fields]

# Feature tiers: per track, per artist, one global row.
TRACK_FEATURES_SCHEMA = T.StructType(
    [T.StructField("id", _S, True)] + [f for f in CATALOG_SCHEMA.fields if f.name in CATALOG_FEATURES]
)
AGG_FEATURES_FIELDS = [T.StructField(f, _D, True) for f in CATALOG_FEATURES]
ARTIST_FEATURES_SCHEMA = T.StructType([T.StructField("artist", _S, True)] + AGG_FEATURES_FIELDS)
GLOBAL_FEATURES_SCHEMA = T.StructType(AGG_FEATURES_FIELDS)


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


# Result-table contracts (column name -> type, NOT NULL columns, defaults).
# Decimals appear only here, at the sink; everything in flight is double.
CONTRACTS: dict[str, dict] = {
    "realtime_streaming_events": {
        "schema": _struct(
            ("timestamp", _TS), ("track_uri", _S), ("track_name", _S), ("album_name", _S),
            ("artist_name", _S), ("ms_played", _I), ("energy", _dec(5, 4)), ("valence", _dec(5, 4)),
            ("danceability", _dec(5, 4)), ("acousticness", _dec(5, 4)), ("duration_ms", _L),
            ("year", _I), ("completion_rate", _dec(5, 4)), ("is_skip", _B),
            ("hour_of_day", _I), ("day_of_week", _I),
        ),
        "not_null": ["timestamp"],
        "defaults": {},
    },
    "realtime_leaderboard": {
        "schema": _struct(("window_start_time", _TS), ("track_uri", _S), ("track_name", _S),
                          ("artist_name", _S), ("play_count", _I)),
        "not_null": ["window_start_time"],
        "defaults": {},
    },
    "realtime_mood_metrics": {
        "schema": _struct(("window_start_time", _TS), ("avg_valence", _dec(5, 4)),
                          ("avg_energy", _dec(5, 4)), ("total_streams", _I),
                          # sums kept beside the averages so batches can be re-weighted later
                          ("sum_valence", _D), ("sum_energy", _D)),
        "not_null": ["window_start_time"],
        "defaults": {},
    },
    "engagement_metrics": {
        "schema": _struct(("window_start_time", _TS), ("track_uri", _S), ("completion_rate", _dec(5, 4)),
                          ("skip_count", _I), ("natural_end_count", _I)),
        "not_null": ["window_start_time"],
        "defaults": {},
    },
    "mood_matrix_samples": {
        "schema": _struct(("timestamp", _TS), ("track_uri", _S), ("artist_name", _S),
                          ("valence", _dec(5, 4)), ("energy", _dec(5, 4))),
        "not_null": ["timestamp"],
        "defaults": {},
    },
    "system_metrics": {
        "schema": _struct(("timestamp", _TS), ("events_per_second", _I), ("spark_processing_delay_ms", _I)),
        "not_null": [],
        "defaults": {},
    },
    "quarantine": {
        "schema": _struct(("raw", _S), ("reason", _S)),
        "not_null": [],
        "defaults": {},
    },
    "artists": {
        "schema": _struct(
            ("artist_name", _S), ("avg_duration_ms", _L), ("avg_popularity", _dec(5, 2)),
            ("avg_explicit", _dec(5, 4)), ("avg_danceability", _dec(5, 4)), ("avg_energy", _dec(5, 4)),
            ("avg_loudness", _dec(10, 4)), ("avg_speechiness", _dec(5, 4)), ("avg_acousticness", _dec(5, 4)),
            ("avg_instrumentalness", _dec(5, 4)), ("avg_liveness", _dec(5, 4)), ("avg_valence", _dec(5, 4)),
            ("avg_tempo", _dec(7, 3)), ("total_play_count", _I), ("total_skip_count", _I),
            ("total_listening_time_ms", _L), ("avg_listening_time_ms", _L), ("likeability_score", _dec(5, 4)),
        ),
        "not_null": ["artist_name"],
        "defaults": {"total_play_count": 0, "total_skip_count": 0,
                     "total_listening_time_ms": 0, "avg_listening_time_ms": 0},
        "key": ["artist_name"],
    },
    "albums": {
        "schema": _struct(("album_name", _S), ("artist_name", _S), ("year", _I)),
        "not_null": ["album_name"],
        "defaults": {},
        "key": ["album_name"],
    },
    "tracks": {
        "schema": _struct(
            ("track_uri", _S), ("track_name", _S), ("album_name", _S), ("artist_name", _S),
            ("duration_ms", _L), ("explicit", _I), ("popularity", _I), ("year", _I),
            ("danceability", _dec(5, 4)), ("energy", _dec(5, 4)), ("loudness", _dec(10, 4)),
            ("speechiness", _dec(5, 4)), ("acousticness", _dec(5, 4)), ("instrumentalness", _dec(5, 4)),
            ("liveness", _dec(5, 4)), ("valence", _dec(5, 4)), ("tempo", _dec(7, 3)),
            ("total_play_count", _I), ("total_skip_count", _I), ("total_listening_time_ms", _L),
            ("avg_listening_time_ms", _L), ("likeability_score", _dec(5, 4)),
        ),
        "not_null": ["track_uri", "track_name"],
        "defaults": {"total_play_count": 0, "total_skip_count": 0,
                     "total_listening_time_ms": 0, "avg_listening_time_ms": 0},
        "key": ["track_uri"],
    },
    "global_fallback_metrics": {
        "schema": _struct(
            ("name", _S), ("avg_duration_ms", _L), ("avg_danceability", _dec(5, 4)), ("avg_energy", _dec(5, 4)),
            ("avg_loudness", _dec(10, 4)), ("avg_speechiness", _dec(5, 4)), ("avg_acousticness", _dec(5, 4)),
            ("avg_instrumentalness", _dec(5, 4)), ("avg_liveness", _dec(5, 4)), ("avg_valence", _dec(5, 4)),
            ("avg_tempo", _dec(7, 3)),
        ),
        "not_null": [],
        "defaults": {"name": "Others"},
    },
}

# Most characters of a text column of a result table, and of the columns with a bound of their own
# (the messages put aside have none).
MAX_TEXT = 255
TEXT_LENGTHS = {("global_fallback_metrics", "name"): 50}
UNBOUNDED_TABLES = ["quarantine"]

# The five tables one micro-batch writes, in write order.
BATCH_TABLES = [
    "realtime_streaming_events", "realtime_leaderboard", "realtime_mood_metrics",
    "engagement_metrics", "mood_matrix_samples",
]
