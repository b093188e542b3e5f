"""Tiered enrichment of plays with song features.

Each play takes the *whole* feature row of the first tier that knows it:
exact track id, else exact artist name, else the global row, else zeros.
This is two left equi-joins and one scalar subquery, all in one Catalyst
plan (no per-row lookups, no Python):

* track tier — large (one row per catalog track). Joined by the planner:
  sort-merge on the track id when it is too big to broadcast; AQE splits a
  hot track's partition on the play side (the track side has one row per key).
  Against a persisted tier (streaming), where AQE cannot split, hot tracks
  are joined map-side instead (``hot_track_fraction``).
* artist tier — broadcast only after :func:`broadcast_if_small` has
  measured it; otherwise shuffled like the track tier.
* global tier — one row, read through scalar subqueries (Spark merges them
  into one and fails if the row is not unique).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions import completion_rate, hour_of_day, is_skip, iso_weekday, parse_ts
from cadence.operators.sizing import broadcast_if_small
from cadence.operators.skew import split_hot_join
from cadence.schemas import ENRICH_FEATURES, ENRICHED_COLUMNS

_INT_TYPES = {"duration_ms": "long", "year": "int"}


def _tier_value(name: str, tier: Column, g: dict[str, Column]) -> Column:
    v = (F.when(tier == "track", F.col(f"_t_{name}").cast("double"))
         .when(tier == "artist", F.col(f"_a_{name}").cast("double"))
         .otherwise(g[name].cast("double")))
    v = F.coalesce(v, F.lit(0.0))
    # whole numbers are read as double and truncated, as the store keeps them as numbers
    return v.cast(_INT_TYPES[name]) if name in _INT_TYPES else v


def spread_nulls(key: str, rows: DataFrame) -> Column:
    """``key``, or where it is null a text that no id or name equals, different from row to row.

    Null keys match nothing in a left join, but would all be shuffled to one task.
    """
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.xxhash64(*rows.columns).cast("string")))


def enrich(logs: DataFrame, tracks: DataFrame, artists: DataFrame, global_row: DataFrame,
           *, with_tier: bool = False, artist_broadcast_bytes: int | None = None,
           extra: list[str] | None = None, hot_track_fraction: float | None = None,
           log_rows: int | None = None) -> DataFrame:
    """Enriched plays (ENRICHED_SCHEMA order); ``with_tier`` adds the J2 label column ``tier``.

    ``logs`` has the log-record columns (ts text, ms_played, spotify_track_uri,
    track_name, album_name, artist_name, skipped, reason_end). Rows whose ts
    cannot be parsed get a null timestamp; use :func:`split_quarantine` first.
    ``extra`` names input columns to carry through (e.g. a batch id).
    ``hot_track_fraction`` joins tracks holding at least that share of the
    plays map-side (:func:`split_hot_join`); use it where AQE cannot split
    skew, i.e. against a persisted track tier, with ``logs`` persisted
    (``log_rows``: its row count, when known).
    """
    t = tracks.select(F.col("id").alias("_t_key"), *[F.col(f).alias(f"_t_{f}") for f in ENRICH_FEATURES])
    a = artists.select(F.col("artist").alias("_a_key"), *[F.col(f).alias(f"_a_{f}") for f in ENRICH_FEATURES])
    a = broadcast_if_small(a, artist_broadcast_bytes)
    g = {f: global_row.select(F.col(f)).scalar() for f in ENRICH_FEATURES}

    if hot_track_fraction:
        j = split_hot_join(logs, t, "spotify_track_uri", "_t_key", "left", hot_track_fraction, left_rows=log_rows)
    else:
        j = logs.join(t, spread_nulls("spotify_track_uri", logs) == F.col("_t_key"), "left")
    j = j.join(a, spread_nulls("artist_name", logs) == F.col("_a_key"), "left")
    tier = (F.when(F.col("_t_key").isNotNull(), F.lit("track"))
            .when(F.col("_a_key").isNotNull(), F.lit("artist"))
            .otherwise(F.lit("others")))
    j = j.withColumn("tier", tier)
    feats = {f: _tier_value(f, F.col("tier"), g) for f in ENRICH_FEATURES}
    ts = parse_ts(F.col("ts"))
    ms = F.coalesce(F.col("ms_played"), F.lit(0)).cast("int")
    cols = {
        "timestamp": ts,
        "track_uri": F.col("spotify_track_uri"),
        "track_name": F.col("track_name"),
        "album_name": F.col("album_name"),
        "artist_name": F.col("artist_name"),
        "ms_played": ms,
        **feats,
        "completion_rate": completion_rate(ms, feats["duration_ms"]),
        "is_skip": is_skip(F.col("skipped"), F.col("reason_end")),
        "hour_of_day": hour_of_day(ts),
        "day_of_week": iso_weekday(ts),
    }
    out = [cols[c].alias(c) for c in ENRICHED_COLUMNS]
    if with_tier:
        out.append(F.col("tier"))
    out += [F.col(c) for c in (extra or [])]
    return j.select(*out)


def split_quarantine(parsed: DataFrame, raw_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) of parsed log records.

    A row is quarantined when its ts is missing or unreadable (this also
    covers malformed JSON, which parses to an all-null record). Both outputs
    are filters over the same input, so nothing is dropped silently.
    """
    ok = parse_ts(F.col("ts")).isNotNull()
    valid = parsed.where(ok)
    raw = F.col(raw_col) if raw_col else F.to_json(F.struct(*[F.col(c) for c in parsed.columns]))
    reason = F.when(F.col("ts").isNull(), F.lit("missing ts")).otherwise(F.lit("unreadable ts"))
    bad = parsed.where(~F.coalesce(ok, F.lit(False))).select(raw.alias("raw"), reason.alias("reason"))
    return valid, bad
