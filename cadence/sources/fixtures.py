"""Catalog and listening history derived from the test tables.

The test data has no music tables, so the song catalog is derived from
``part`` and the listening history from ``events`` joined to ``part``.
The derivation is a fixed rule (see FIXTURES.md); it keeps every event, and
leaves some parts out of the catalog on purpose so that all three
enrichment tiers (track, artist, global) are exercised.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the derivation rule (FIXTURES.md §2).
TRACK_ID_PREFIX = "t"
SECOND_ARTIST = "x"
UNLISTED_BRAND = "Brand#7"      # its plays name an unknown track and artist -> global tier
UNLISTED_TRACK_PREFIX, UNLISTED_ARTIST = "u", "Unlisted#7"
ARTIST_ONLY_MODULUS = 4         # plays of parts with key % 4 == 0 name an unknown track -> artist tier
COMMA_MODULUS = 13              # parts whose artist list ends with a comma
FEATURED_MODULUS = 37           # parts whose artists text goes on after the list (no list literal)
NONE_MODULUS = 41               # parts whose artist list starts with None (no first artist)
NULL_DURATION_MODULUS = 31      # parts with key % 31 == 0 get a null duration -> dropped
NULL_MS_MODULUS = 23            # events with id % 23 == 0 have no ms_played
NAN_MS_MODULUS = 43             # events with id % 43 == 0 have ms_played NaN
HUGE_MS_MODULUS = 47            # events with id % 47 == 0 have an ms_played beyond int
HUGE_MS = 1e12
NULL_URI_MODULUS = 19           # events with id % 19 == 0 have no track uri
NULL_ARTIST_MODULUS = 17        # events with id % 17 == 0 have no artist
EVENT_KEY_FACTOR = 7            # part key = (event_id * 7 + user_id) % count(part)
MS_PER_VALUE = 4000
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _frac(key: Column, mult: int, mod: int = 1000, scale: float = 1000.0) -> Column:
    return ((key * mult) % mod).cast("double") / scale


def catalog_from_part(part: DataFrame) -> DataFrame:
    """Song catalog in the raw catalog layout (id, artists list literal, 13 features)."""
    k = F.col("p_partkey")
    q = F.lit("'")
    quoted = F.concat(q, F.col("p_brand"), q)
    artists = (
        F.when(k % NONE_MODULUS == 0, F.concat(F.lit("[None, "), quoted, F.lit("]")))
        .when(k % FEATURED_MODULUS == 0, F.concat(F.lit("["), quoted, F.lit("] feat "), F.lit(SECOND_ARTIST)))
        .when(k % COMMA_MODULUS == 0, F.concat(F.lit("["), quoted, F.lit(",]")))
        .otherwise(F.concat(F.lit("["), quoted, F.lit(", "), q, F.lit(SECOND_ARTIST), q, F.lit("]")))
    )
    return (
        part.select(
            F.concat(F.lit(TRACK_ID_PREFIX), k.cast("string")).alias("id"),
            artists.alias("artists"),
            _frac(k, 37).alias("valence"),
            _frac(k, 91).alias("energy"),
            (F.col("p_size").cast("double") / 50).alias("danceability"),
            _frac(k, 53).alias("acousticness"),
            _frac(k, 17).alias("instrumentalness"),
            _frac(k, 29).alias("liveness"),
            (-_frac(k, 13, 60000)).alias("loudness"),
            _frac(k, 71).alias("speechiness"),
            (F.lit(60.0) + ((k * 7) % 140).cast("double")).alias("tempo"),
            (k % 101).cast("int").alias("popularity"),
            F.when(k % NULL_DURATION_MODULUS == 0, F.lit(None).cast("long"))
            .otherwise(F.floor(F.col("p_retailprice") * 200).cast("long")).alias("duration_ms"),
            (k % 2).cast("int").alias("explicit"),
            (F.lit(1940) + k % 85).cast("int").alias("year"),
        )
    )


def history_from_events(events: DataFrame, part: DataFrame) -> DataFrame:
    """Raw listening history: every event becomes one play of a part-derived track.

    The part count is a scalar subquery, evaluated once inside the plan.
    The join is an equi-join on the computed key; the planner broadcasts
    ``part`` only when its file size is under the broadcast threshold and
    otherwise shuffles both sides.
    """
    n_parts = part.select(F.count(F.lit(1))).scalar()
    e = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        ((F.col("event_id") * EVENT_KEY_FACTOR + F.col("user_id")) % n_parts).alias("_pk"),
    )
    p = part.select("p_partkey", "p_name", "p_type", "p_brand")
    j = e.join(p, e["_pk"] == p["p_partkey"], "inner")
    eid, et = F.col("event_id"), F.col("event_type")
    unlisted = F.col("p_brand") == UNLISTED_BRAND
    prefix = F.when(unlisted | (F.col("p_partkey") % ARTIST_ONLY_MODULUS == 0), UNLISTED_TRACK_PREFIX).otherwise(TRACK_ID_PREFIX)
    return j.select(
        eid.alias("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.when(eid % NULL_MS_MODULUS == 0, F.lit(None).cast("double"))
        .when(eid % NAN_MS_MODULUS == 0, F.lit(float("nan"))).when(eid % HUGE_MS_MODULUS == 0, F.lit(HUGE_MS))
        .otherwise(F.floor(F.col("value") * MS_PER_VALUE) + F.lit(0.5)).alias("ms_played"),
        F.when(eid % NULL_URI_MODULUS == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(prefix, F.col("p_partkey").cast("string"))).alias("spotify_track_uri"),
        F.col("p_name").alias("track_name"),
        F.col("p_type").alias("album_name"),
        F.when(eid % NULL_ARTIST_MODULUS == 0, F.lit(None).cast("string"))
        .otherwise(F.when(unlisted, UNLISTED_ARTIST).otherwise(F.col("p_brand"))).alias("artist_name"),
        F.when(F.col("user_id") % 2 == 0, F.lit("TRUE")).otherwise(F.lit("false")).alias("shuffle"),
        F.when(et == "error", F.lit("True")).when(et == "signup", F.lit(None).cast("string"))
        .otherwise(F.lit("FALSE")).alias("skipped"),
        F.when(et == "click", F.lit("ForwardSkipBtn")).when(et == "view", F.lit("trackdone"))
        .otherwise(F.lit(None).cast("string")).alias("reason_end"),
    )
