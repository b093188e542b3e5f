"""DuckDB SQL for every registered batch query (the correctness oracle).

Each statement runs on the raw test tables (``part``, ``events`` views)
and repeats the whole derivation in SQL: catalog and history, cleaning,
tiers, enrichment, then the query. Two helpers mirror Spark's rounding of
doubles: the decimal value is taken at 12 places first, then rounded
(half-even for ``bround``, half-up for ``round``).
"""

from __future__ import annotations

from cadence.schemas import CATALOG_FEATURES

DOUBLE_FEATURES = ["valence", "energy", "danceability", "acousticness", "instrumentalness", "liveness",
                   "loudness", "speechiness", "tempo"]


def r4(x: str) -> str:
    return f"CAST(round_even(CAST({x} AS DECIMAL(38,12)), 4) AS DOUBLE)"


def p6(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), 6) AS DOUBLE)"


def q(name: str) -> str:
    return f'"{name}"'


_not_null = " AND ".join(
    [f"{q(c)} IS NOT NULL" for c in ["id", "artists"] + CATALOG_FEATURES]
    + [f"NOT isnan({c})" for c in DOUBLE_FEATURES]
)

FIRST_ARTIST = (r"CASE WHEN regexp_matches(artists, '^\[None[,\]]') THEN NULL "
                r"WHEN regexp_matches(artists, '^\[''[^'']*''(, ?''[^'']*'')*,?\]$') "
                r"THEN regexp_extract(artists, '^\[''([^'']*)''', 1) ELSE artists END")


def _tier_pick(f: str) -> str:
    return (f"COALESCE(CASE WHEN t.id IS NOT NULL THEN CAST(t.{q(f)} AS DOUBLE) "
            f"WHEN a.artist IS NOT NULL THEN a.{q(f)} ELSE g.{q(f)} END, 0.0)")


PRELUDE = f"""
WITH catalog AS (
  SELECT 't' || CAST(p_partkey AS VARCHAR) AS id,
    CASE WHEN p_partkey % 41 = 0 THEN '[None, ' || chr(39) || p_brand || chr(39) || ']'
      WHEN p_partkey % 37 = 0 THEN '[' || chr(39) || p_brand || chr(39) || '] feat x'
      WHEN p_partkey % 13 = 0 THEN '[' || chr(39) || p_brand || chr(39) || ',]'
      ELSE '[' || chr(39) || p_brand || chr(39) || ', ' || chr(39) || 'x' || chr(39) || ']' END AS artists,
    CAST(p_partkey*37 % 1000 AS DOUBLE)/1000 AS valence,
    CAST(p_partkey*91 % 1000 AS DOUBLE)/1000 AS energy,
    CAST(p_size AS DOUBLE)/50 AS danceability,
    CAST(p_partkey*53 % 1000 AS DOUBLE)/1000 AS acousticness,
    CAST(p_partkey*17 % 1000 AS DOUBLE)/1000 AS instrumentalness,
    CAST(p_partkey*29 % 1000 AS DOUBLE)/1000 AS liveness,
    -CAST(p_partkey*13 % 60000 AS DOUBLE)/1000 AS loudness,
    CAST(p_partkey*71 % 1000 AS DOUBLE)/1000 AS speechiness,
    60 + CAST(p_partkey*7 % 140 AS DOUBLE) AS tempo,
    CAST(p_partkey % 101 AS INTEGER) AS popularity,
    CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE CAST(FLOOR(p_retailprice*200) AS BIGINT) END AS duration_ms,
    CAST(p_partkey % 2 AS INTEGER) AS explicit,
    CAST(1940 + p_partkey % 85 AS INTEGER) AS "year"
  FROM part
),
raw_history AS (
  SELECT e.event_id, CAST(e.ts AS TIMESTAMP) AS ts,
    CASE WHEN e.event_id % 23 = 0 THEN NULL WHEN e.event_id % 43 = 0 THEN CAST('NaN' AS DOUBLE)
      WHEN e.event_id % 47 = 0 THEN 1e12 ELSE FLOOR(e.value*4000) + 0.5 END AS ms_played,
    CASE WHEN e.event_id % 19 = 0 THEN NULL
      ELSE (CASE WHEN p.p_brand = 'Brand#7' OR p.p_partkey % 4 = 0 THEN 'u' ELSE 't' END)
        || CAST(p.p_partkey AS VARCHAR) END AS spotify_track_uri,
    p.p_name AS track_name, p.p_type AS album_name,
    CASE WHEN e.event_id % 17 = 0 THEN NULL WHEN p.p_brand = 'Brand#7' THEN 'Unlisted#7' ELSE p.p_brand END AS artist_name,
    CASE WHEN e.user_id % 2 = 0 THEN 'TRUE' ELSE 'false' END AS shuffle,
    CASE WHEN e.event_type = 'error' THEN 'True' WHEN e.event_type = 'signup' THEN NULL ELSE 'FALSE' END AS skipped,
    CASE e.event_type WHEN 'click' THEN 'ForwardSkipBtn' WHEN 'view' THEN 'trackdone' END AS reason_end
  FROM (SELECT *, (event_id * 7 + user_id) % (SELECT count(*) FROM part) AS pk FROM events) e
  JOIN part p ON p.p_partkey = e.pk
),
clean_catalog AS (
  SELECT id, artists, {", ".join(q(c) for c in CATALOG_FEATURES)}, {FIRST_ARTIST} AS artist
  FROM catalog WHERE {_not_null}
),
tracks AS (
  SELECT id, {", ".join(f"{r4(q(c))} AS {q(c)}" if c in DOUBLE_FEATURES else q(c) for c in CATALOG_FEATURES)}
  FROM clean_catalog
),
artists_t AS (
  SELECT artist, {", ".join(f"{r4(f'avg({q(c)})')} AS {q(c)}" for c in CATALOG_FEATURES)}
  FROM clean_catalog WHERE artist IS NOT NULL GROUP BY artist
),
global_t AS (
  SELECT {", ".join(f"{r4(f'avg({q(c)})')} AS {q(c)}" for c in CATALOG_FEATURES)} FROM clean_catalog
),
history AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
    CAST(CASE WHEN ms_played IS NULL OR isnan(ms_played) OR ms_played >= 2147483648 THEN 0
      ELSE trunc(ms_played) END AS INTEGER) AS ms_played,
    spotify_track_uri, track_name, album_name, artist_name,
    COALESCE(upper(shuffle) = 'TRUE', false) AS shuffle,
    COALESCE(upper(skipped) = 'TRUE', false) AS skipped,
    reason_end
  FROM raw_history
  WHERE ts IS NOT NULL AND spotify_track_uri IS NOT NULL AND artist_name IS NOT NULL
),
joined AS (
  SELECT h.*,
    CASE WHEN t.id IS NOT NULL THEN 'track' WHEN a.artist IS NOT NULL THEN 'artist' ELSE 'others' END AS tier,
    {_tier_pick("energy")} AS energy,
    {_tier_pick("valence")} AS valence,
    {_tier_pick("danceability")} AS danceability,
    {_tier_pick("acousticness")} AS acousticness,
    CAST(trunc({_tier_pick("duration_ms")}) AS BIGINT) AS duration_ms,
    CAST(trunc({_tier_pick("year")}) AS INTEGER) AS "year"
  FROM history h
  LEFT JOIN tracks t ON h.spotify_track_uri = t.id
  LEFT JOIN artists_t a ON h.artist_name = a.artist
  LEFT JOIN global_t g ON TRUE
),
enriched_tiered AS (
  SELECT CAST(ts AS TIMESTAMP) AS "timestamp", spotify_track_uri AS track_uri, track_name, album_name,
    artist_name, ms_played, energy, valence, danceability, acousticness, duration_ms, "year",
    CASE WHEN duration_ms > 0 THEN least(CAST(ms_played AS DOUBLE) / duration_ms, 1.0) ELSE 0.0 END
      AS completion_rate,
    (COALESCE(skipped, false) OR COALESCE(contains(lower(reason_end), 'skip'), false)) AS is_skip,
    CAST(hour(CAST(ts AS TIMESTAMP)) AS INTEGER) AS hour_of_day,
    CAST(isodow(CAST(ts AS TIMESTAMP)) AS INTEGER) AS day_of_week,
    tier
  FROM joined
),
enriched AS (SELECT * EXCLUDE (tier) FROM enriched_tiered)
"""

SKIP_RATE = "CAST(SUM(CASE WHEN is_skip THEN 1 ELSE 0 END) AS DOUBLE) / GREATEST(COUNT(*), 1)"
ENRICHED_SELECT = ('"timestamp", track_uri, track_name, album_name, artist_name, ms_played, '
                   + ", ".join(f"{p6(c)} AS {c}" for c in ["energy", "valence", "danceability", "acousticness"])
                   + ', duration_ms, "year", ' + p6("completion_rate")
                   + " AS completion_rate, is_skip, hour_of_day, day_of_week")
WEEKDAY_CASE = ("CASE day_of_week WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed' WHEN 4 THEN 'Thu' "
                "WHEN 5 THEN 'Fri' WHEN 6 THEN 'Sat' WHEN 7 THEN 'Sun' END")


def _features() -> str:
    """The 13 catalog features: doubles shown at 6 places, whole numbers as they are."""
    return ", ".join(f"{p6(q(c))} AS {q(c)}" if c in DOUBLE_FEATURES else q(c) for c in CATALOG_FEATURES)


def _like() -> str:
    return f"""
  SELECT artist_name, avg(completion_rate) AS avg_completion, {SKIP_RATE} AS skip_rate,
    COUNT(*) AS plays
  FROM enriched WHERE artist_name IS NOT NULL GROUP BY artist_name HAVING COUNT(*) >= 1"""


_LIKE = f"""
, liked AS (SELECT *, greatest(-1.0, least(1.0, avg_completion - skip_rate)) AS likeability FROM ({_like()}))
SELECT artist_name, {p6("avg_completion")} AS avg_completion, {p6("skip_rate")} AS skip_rate, plays,
  {p6("likeability")} AS likeability
FROM (SELECT * FROM liked ORDER BY likeability DESC, artist_name LIMIT 10)
"""

_PROFILE_FEATS = ["popularity", "explicit", "danceability", "energy", "loudness", "speechiness",
                  "acousticness", "instrumentalness", "liveness", "valence", "tempo"]
_FALLBACK_FEATS = ["danceability", "energy", "loudness", "speechiness", "acousticness",
                   "instrumentalness", "liveness", "valence", "tempo"]


def _totals(key: str) -> str:
    return f"""SELECT {key}, COUNT(*) AS total_play_count,
      CAST(SUM(CASE WHEN is_skip THEN 1 ELSE 0 END) AS BIGINT) AS total_skip_count,
      CAST(SUM(CAST(ms_played AS BIGINT)) AS BIGINT) AS total_listening_time_ms,
      CAST(trunc(avg(ms_played)) AS BIGINT) AS avg_listening_time_ms,
      {r4(f"greatest(-1.0, least(1.0, avg(completion_rate) - {SKIP_RATE}))")} AS likeability_score"""


_ARTIST_PROFILE = f"""
, cat AS (
  SELECT artist AS artist_name, CAST(trunc(avg(duration_ms)) AS BIGINT) AS avg_duration_ms,
    {", ".join(f"{r4(f'avg({c})')} AS avg_{c}" for c in _PROFILE_FEATS)}
  FROM clean_catalog WHERE artist IS NOT NULL GROUP BY artist
), pl AS ({_totals("artist_name")} FROM enriched WHERE artist_name IS NOT NULL GROUP BY artist_name)
, artist_profile AS (
SELECT cat.artist_name, avg_duration_ms, {", ".join(f"avg_{c}" for c in _PROFILE_FEATS)},
  COALESCE(total_play_count, 0) AS total_play_count, COALESCE(total_skip_count, 0) AS total_skip_count,
  COALESCE(total_listening_time_ms, 0) AS total_listening_time_ms,
  COALESCE(avg_listening_time_ms, 0) AS avg_listening_time_ms, likeability_score
FROM cat LEFT JOIN pl ON cat.artist_name = pl.artist_name)
"""

_ALBUM_DIM = """
, album_dim AS (
  SELECT album_name, first.a AS artist_name, first.y AS "year" FROM (
    SELECT album_name, min({'t': "timestamp", 'a': artist_name, 'y': "year"}) AS first
    FROM enriched WHERE album_name IS NOT NULL GROUP BY album_name))
"""

def _pct2(num: str, den: str) -> str:
    """num * 100 / den, rounded half-even to 2 places of its decimal value; null when den is 0."""
    return f"CAST(round_even(CAST(({num}) * 100.0 / NULLIF({den}, 0) AS DECIMAL(38,12)), 2) AS DOUBLE)"


def _coverage(normalize: bool) -> str:
    """C1 written the plain way (COUNT DISTINCT over flagged rows), independent of the Spark plan."""
    cat_key = f"lower(trim({FIRST_ARTIST}))" if normalize else FIRST_ARTIST
    log_key = "lower(trim(h.artist_name))" if normalize else "h.artist_name"
    return f"""
      , ids AS (SELECT DISTINCT id FROM catalog WHERE id IS NOT NULL)
      , arts AS (SELECT DISTINCT {cat_key} AS k FROM catalog WHERE artists IS NOT NULL)
      , flags AS (
        SELECT h.spotify_track_uri AS uri, i.id IS NOT NULL AS id_hit, a.k IS NOT NULL AS art_hit
        FROM raw_history h LEFT JOIN ids i ON h.spotify_track_uri = i.id
        LEFT JOIN arts a ON {log_key} = a.k)
      , tot AS (
        SELECT COUNT(DISTINCT uri) AS distinct_tracks,
          COUNT(DISTINCT CASE WHEN id_hit THEN uri END) AS matched_tracks,
          COUNT(*) AS total_logs,
          CAST(SUM(CASE WHEN id_hit THEN 1 ELSE 0 END) AS BIGINT) AS track_logs,
          CAST(SUM(CASE WHEN NOT id_hit AND art_hit THEN 1 ELSE 0 END) AS BIGINT) AS artist_logs
        FROM flags)
      SELECT distinct_tracks, matched_tracks, {_pct2("matched_tracks", "distinct_tracks")} AS track_match_pct,
        total_logs, track_logs, {_pct2("track_logs", "total_logs")} AS track_logs_pct,
        artist_logs, {_pct2("artist_logs", "total_logs")} AS artist_logs_pct,
        total_logs - track_logs - artist_logs AS others_logs,
        {_pct2("total_logs - track_logs - artist_logs", "total_logs")} AS others_pct,
        {_pct2("track_logs + artist_logs", "total_logs")} AS coverage_pct
      FROM tot"""


_FEATURE_KEYS = f"""
      SELECT 'track:' || id AS "key", 'track' AS scope,
        {', '.join(f'{p6(f"CAST({q(c)} AS DOUBLE)")} AS {q(c)}' for c in CATALOG_FEATURES)} FROM tracks
      UNION ALL
      SELECT 'artist:' || artist, 'artist', {', '.join(p6(q(c)) for c in CATALOG_FEATURES)} FROM artists_t
      UNION ALL
      SELECT 'global:OTHERS', 'global', {', '.join(p6(q(c)) for c in CATALOG_FEATURES)} FROM global_t"""

_SELECTS: dict[str, str] = {
    "enriched_events": f"SELECT {ENRICHED_SELECT} FROM enriched",
    "match_tiers": 'SELECT "timestamp", track_uri, artist_name, tier FROM enriched_tiered',
    "clean_catalog": f"SELECT id, artists, {_features()}, artist FROM clean_catalog",
    "clean_history": ("SELECT event_id, ts, ms_played, spotify_track_uri, track_name, album_name, artist_name, "
                      "shuffle, skipped, reason_end FROM history"),
    "track_features": f"SELECT id, {_features()} FROM tracks",
    "artist_features": f"SELECT artist, {', '.join(f'{p6(q(c))} AS {q(c)}' for c in CATALOG_FEATURES)} FROM artists_t",
    "global_features": f"SELECT {', '.join(f'{p6(q(c))} AS {q(c)}' for c in CATALOG_FEATURES)} FROM global_t",
    "feature_keys": _FEATURE_KEYS,
    "features_from_json": _FEATURE_KEYS,
    "duplicate_keys": """
      SELECT spotify_track_uri, COUNT(*) AS n FROM history WHERE spotify_track_uri IS NOT NULL
      GROUP BY spotify_track_uri HAVING COUNT(*) > 1""",
    "catalog_id_duplicates": """
      SELECT id, COUNT(*) AS n FROM clean_catalog WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1""",
    "orphans": f"""{_ARTIST_PROFILE}
      SELECT "timestamp", track_uri, artist_name FROM enriched e WHERE e.artist_name IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM artist_profile p WHERE p.artist_name = e.artist_name)""",
    "orphans_tracks_albums": f"""{_ALBUM_DIM}
      , named AS (SELECT track_uri, first.a AS album_name FROM (
          SELECT track_uri, min({{'t': "timestamp", 'n': track_name, 'a': album_name}}) AS first
          FROM enriched WHERE track_uri IS NOT NULL GROUP BY track_uri))
      SELECT c.id AS track_uri, n.album_name FROM clean_catalog c JOIN named n ON n.track_uri = c.id
      WHERE n.album_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM album_dim d WHERE d.album_name = n.album_name)""",
    "orphans_albums_artists": f"""{_ARTIST_PROFILE}{_ALBUM_DIM}
      SELECT album_name, artist_name, "year" FROM album_dim d WHERE artist_name IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM artist_profile p WHERE p.artist_name = d.artist_name)""",
    "coverage_report": _coverage(True),
    "coverage_exact": _coverage(False),
    "known_tracks": """
      SELECT DISTINCT h.spotify_track_uri AS track_uri FROM raw_history h
      WHERE h.spotify_track_uri IS NOT NULL AND h.spotify_track_uri IN (SELECT id FROM catalog)""",
    "unmatched_logs": """
      SELECT event_id, spotify_track_uri, artist_name FROM raw_history h
      WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.id = h.spotify_track_uri)""",
    "matched_logs": """
      SELECT event_id, spotify_track_uri, artist_name FROM raw_history h
      WHERE EXISTS (SELECT 1 FROM catalog c WHERE c.id = h.spotify_track_uri)""",
    "distinct_artists": "SELECT DISTINCT artist_name FROM history WHERE artist_name IS NOT NULL",
    "windowed_leaderboard": """
      SELECT w AS window_start_time, w + INTERVAL '10 minutes' AS window_end_time, track_uri,
        first.n AS track_name, first.a AS artist_name, play_count FROM (
        SELECT time_bucket(INTERVAL '10 minutes', "timestamp") AS w, track_uri,
          min({'t': "timestamp", 'n': track_name, 'a': artist_name}) AS first, COUNT(*) AS play_count
        FROM enriched GROUP BY 1, 2)""",
    "windowed_engagement": f"""
      SELECT time_bucket(INTERVAL '10 minutes', "timestamp") AS window_start_time,
        time_bucket(INTERVAL '10 minutes', "timestamp") + INTERVAL '10 minutes' AS window_end_time, track_uri,
        {p6("avg(completion_rate)")} AS completion_rate,
        CAST(SUM(CASE WHEN is_skip THEN 1 ELSE 0 END) AS BIGINT) AS skip_count,
        CAST(SUM(CASE WHEN NOT is_skip THEN 1 ELSE 0 END) AS BIGINT) AS natural_end_count
      FROM enriched GROUP BY 1, 2, 3""",
    "artist_engagement": f"""
      , liked AS (SELECT *, greatest(-1.0, least(1.0, avg_completion - skip_rate)) AS likeability FROM ({_like()}))
      SELECT artist_name, {p6("avg_completion")} AS avg_completion, {p6("skip_rate")} AS skip_rate, plays,
        {p6("likeability")} AS likeability FROM liked""",
    "top_tracks_recent": """
      , lb AS (
        SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS w, track_uri,
          min({'t': "timestamp", 'n': track_name, 'a': artist_name}) AS first, COUNT(*) AS play_count
        FROM enriched GROUP BY 1, 2)
      SELECT first.n AS track_name, first.a AS artist_name, CAST(SUM(play_count) AS BIGINT) AS plays
      FROM lb WHERE w >= (SELECT max(CAST(ts AS TIMESTAMP)) FROM history) - INTERVAL 240 MINUTE
      GROUP BY 1, 2 ORDER BY plays DESC, track_name, artist_name LIMIT 10""",
    "events_per_second_recent": """
      SELECT date_trunc('second', "timestamp") AS sec, COUNT(*) AS events FROM enriched
      WHERE "timestamp" >= (SELECT max(CAST(ts AS TIMESTAMP)) FROM history) - INTERVAL 2 MINUTE
      GROUP BY 1 ORDER BY 1""",
    "mood_timeline_recent": f"""
      SELECT * FROM (
        SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS window_start_time,
          {p6("avg(valence)")} AS avg_valence, {p6("avg(energy)")} AS avg_energy, COUNT(*) AS total_streams
        FROM enriched GROUP BY 1)
      WHERE window_start_time >= (SELECT max(CAST(ts AS TIMESTAMP)) FROM history) - INTERVAL 240 MINUTE
      ORDER BY 1""",
    "leaderboard": """
      SELECT track_uri, first.n AS track_name, first.a AS artist_name, play_count FROM (
        SELECT track_uri, min({'t': "timestamp", 'n': track_name, 'a': artist_name}) AS first,
          COUNT(*) AS play_count FROM enriched GROUP BY track_uri)""",
    "mood_metrics": f"""
      SELECT {p6("avg(valence)")} AS avg_valence, {p6("avg(energy)")} AS avg_energy, COUNT(*) AS total_streams,
        {p6("sum(valence)")} AS sum_valence, {p6("sum(energy)")} AS sum_energy FROM enriched""",
    "engagement": f"""
      SELECT track_uri, {p6("avg(completion_rate)")} AS completion_rate,
        CAST(SUM(CASE WHEN is_skip THEN 1 ELSE 0 END) AS BIGINT) AS skip_count,
        CAST(SUM(CASE WHEN NOT is_skip THEN 1 ELSE 0 END) AS BIGINT) AS natural_end_count
      FROM enriched GROUP BY track_uri""",
    "mood_sample": f"""
      SELECT "timestamp", track_uri, artist_name, {p6("valence")} AS valence, {p6("energy")} AS energy
      FROM enriched ORDER BY "timestamp" DESC, track_uri, artist_name, valence, energy LIMIT 200""",
    "windowed_mood": f"""
      SELECT time_bucket(INTERVAL '10 minutes', "timestamp") AS window_start_time,
        time_bucket(INTERVAL '10 minutes', "timestamp") + INTERVAL '10 minutes' AS window_end_time,
        {p6("avg(valence)")} AS avg_valence, {p6("avg(energy)")} AS avg_energy, COUNT(*) AS total_streams,
        {p6("sum(valence)")} AS sum_valence, {p6("sum(energy)")} AS sum_energy
      FROM enriched GROUP BY 1, 2""",
    "kpi": f"""
      SELECT COUNT(*) AS total_events, {p6("avg(valence)")} AS avg_valence, {p6("avg(energy)")} AS avg_energy,
        {p6("avg(completion_rate)")} AS avg_completion, {p6(SKIP_RATE)} AS skip_rate FROM enriched""",
    "kpi_recent": f"""
      SELECT COUNT(*) AS total_events, {p6("avg(valence)")} AS avg_valence, {p6("avg(energy)")} AS avg_energy,
        {p6("avg(completion_rate)")} AS avg_completion, {p6(SKIP_RATE)} AS skip_rate FROM enriched
      WHERE "timestamp" >= (SELECT max(CAST(ts AS TIMESTAMP)) FROM history) - INTERVAL 240 MINUTE""",
    "heatmap": "SELECT day_of_week, hour_of_day, COUNT(*) AS plays FROM enriched GROUP BY day_of_week, hour_of_day",
    "heatmap_grid": f"""
      SELECT d.day_of_week, {WEEKDAY_CASE.replace("day_of_week", "d.day_of_week")} AS day_label,
        {", ".join(f"CAST(COUNT(*) FILTER (WHERE e.hour_of_day = {h}) AS BIGINT) AS h{h:02d}" for h in range(24))}
      FROM (SELECT CAST(range AS INTEGER) AS day_of_week FROM range(1, 8)) d
      LEFT JOIN enriched e ON e.day_of_week = d.day_of_week GROUP BY d.day_of_week""",
    "skip_profile": f"""
      SELECT hour_of_day,
        {p6("AVG(CASE WHEN is_skip THEN danceability END)")} AS skip_danceability,
        {p6("AVG(CASE WHEN NOT is_skip THEN danceability END)")} AS keep_danceability,
        {p6("AVG(CASE WHEN is_skip THEN acousticness END)")} AS skip_acousticness,
        {p6("AVG(CASE WHEN NOT is_skip THEN acousticness END)")} AS keep_acousticness,
        {p6(SKIP_RATE)} AS skip_rate
      FROM enriched GROUP BY hour_of_day ORDER BY hour_of_day""",
    "completion_by_hour": f"""
      SELECT hour_of_day, {p6("AVG(completion_rate)")} AS avg_completion, COUNT(*) AS n
      FROM enriched GROUP BY hour_of_day ORDER BY hour_of_day""",
    "likeability": _LIKE,
    "nostalgia": 'SELECT "year", COUNT(*) AS plays FROM enriched WHERE "year" > 1950 GROUP BY "year" ORDER BY "year"',
    "top_tracks": """
      , lb AS (
        SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS w, track_uri,
          min({'t': "timestamp", 'n': track_name, 'a': artist_name}) AS first, COUNT(*) AS play_count
        FROM enriched GROUP BY 1, 2)
      SELECT first.n AS track_name, first.a AS artist_name, CAST(SUM(play_count) AS BIGINT) AS plays
      FROM lb GROUP BY 1, 2 ORDER BY plays DESC, track_name, artist_name LIMIT 10""",
    "events_per_second": """
      SELECT date_trunc('second', "timestamp") AS sec, COUNT(*) AS events FROM enriched GROUP BY 1 ORDER BY 1""",
    "current_rate": f"""
      SELECT {p6("COALESCE(AVG(events), 0.0)")} AS current_rate FROM (
        SELECT date_trunc('second', "timestamp") AS sec, COUNT(*) AS events FROM enriched
        GROUP BY 1 ORDER BY 1 DESC LIMIT 5)""",
    "mood_timeline": f"""
      SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS window_start_time,
        {p6("avg(valence)")} AS avg_valence, {p6("avg(energy)")} AS avg_energy, COUNT(*) AS total_streams
      FROM enriched GROUP BY 1 ORDER BY 1""",
    "mood_scatter": f"""
      SELECT "timestamp", artist_name, {p6("valence")} AS valence, {p6("energy")} AS energy
      FROM enriched ORDER BY "timestamp" DESC, artist_name, valence, energy LIMIT 3000""",
    "mood_quadrants": f"""
      SELECT CASE WHEN valence IS NULL OR energy IS NULL THEN NULL
        WHEN valence >= 0.5 AND energy >= 0.5 THEN 'energetic_happy'
        WHEN valence < 0.5 AND energy >= 0.5 THEN 'aggressive_tense'
        WHEN valence >= 0.5 AND energy < 0.5 THEN 'calm_happy'
        ELSE 'sad_still' END AS quadrant,
        COUNT(*) AS plays, {p6("avg(valence)")} AS avg_valence, {p6("avg(energy)")} AS avg_energy
      FROM enriched GROUP BY 1""",
    "artist_profile": f"""{_ARTIST_PROFILE}
      SELECT artist_name, avg_duration_ms, {", ".join(f"{p6(f'avg_{c}')} AS avg_{c}" for c in _PROFILE_FEATS)},
        total_play_count, total_skip_count, total_listening_time_ms, avg_listening_time_ms,
        {p6("likeability_score")} AS likeability_score
      FROM artist_profile""",
    "track_profile": f"""
      , pl AS ({_totals("track_uri")},
          min({{'t': "timestamp", 'n': track_name, 'a': album_name}}) AS first
        FROM enriched WHERE track_uri IS NOT NULL GROUP BY track_uri)
      SELECT c.id AS track_uri, pl.first.n AS track_name, pl.first.a AS album_name, c.artist AS artist_name,
        c.duration_ms, c.explicit, c.popularity, c."year",
        {", ".join(f"{p6(r4('c.' + f))} AS {f}" for f in _FALLBACK_FEATS)},
        COALESCE(total_play_count, 0) AS total_play_count, COALESCE(total_skip_count, 0) AS total_skip_count,
        COALESCE(total_listening_time_ms, 0) AS total_listening_time_ms,
        COALESCE(avg_listening_time_ms, 0) AS avg_listening_time_ms, {p6("likeability_score")} AS likeability_score
      FROM clean_catalog c LEFT JOIN pl ON c.id = pl.track_uri""",
    "album_dim": f"{_ALBUM_DIM} SELECT * FROM album_dim",
    "global_fallback": f"""
      SELECT 'Others' AS name, CAST(trunc(avg(duration_ms)) AS BIGINT) AS avg_duration_ms,
        {", ".join(f"{p6(r4(f'avg({c})'))} AS avg_{c}" for c in _FALLBACK_FEATS)}
      FROM clean_catalog""",
}


def batch_oracle() -> dict[str, str]:
    out = {}
    for name, body in _SELECTS.items():
        body = body.strip()
        if body.startswith(","):
            out[name] = PRELUDE.rstrip() + "\n" + body
        else:
            out[name] = PRELUDE + body
    return out
