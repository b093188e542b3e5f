"""C1 coverage report and the set operators it is built from.

The report runs over the raw history and the raw catalog, as a data check
before enrichment. It pre-aggregates the history to one row per
(track uri, artist key) before any join, so a hot track or artist is one
row per task, not a third of the data in one shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions import first_artist, normalized_artist, normalized_name
from cadence.operators.sizing import broadcast_if_small


def distinct_ids(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """The set of non-null values of ``col``."""
    return df.select(F.col(col).alias(alias or col)).where(F.col(alias or col).isNotNull()).distinct()


def known_tracks(history: DataFrame, catalog: DataFrame) -> DataFrame:
    """Track uris of the history that the catalog has (set intersection).

    Written as distinct + semi join on non-null ids: the same set as
    ``intersect`` without its null-safe key, so the distinct output's
    partitioning on the uri is reused by the join.
    """
    ids = distinct_ids(catalog, "id", "_id")
    return (distinct_ids(history, "spotify_track_uri", "track_uri")
            .join(ids, F.col("track_uri") == F.col("_id"), "left_semi"))


def catalog_artist_keys(catalog: DataFrame, normalize: bool = True) -> DataFrame:
    """Distinct artist keys of the catalog: first listed artist, trimmed + lower-cased when ``normalize``."""
    key = normalized_artist("artists") if normalize else first_artist("artists")
    return (catalog.where(F.col("artists").isNotNull()).select(key.alias("_artist_key"))
            .where(F.col("_artist_key").isNotNull()).distinct())


def coverage_report(history: DataFrame, catalog: DataFrame, normalize: bool = True,
                    artist_broadcast_bytes: int | None = None) -> DataFrame:
    """One row of coverage figures.

    distinct_tracks / matched_tracks / track_match_pct — distinct track uris of
    the history and how many the catalog has; total_logs; track_logs (J3),
    artist_logs (J5: no track match but a catalog artist matches) and
    others_logs (J4: the rest), each with a percentage of total_logs, and
    coverage_pct = track + artist share. Percentages are rounded half-even to
    two places; they are null when there is nothing to divide by.
    ``normalize=False`` matches artists exactly, as the enrichment does.
    """
    log_key = normalized_name("artist_name") if normalize else F.col("artist_name")
    pairs = (history.select(F.col("spotify_track_uri").alias("uri"), log_key.alias("_log_artist"))
             .groupBy("uri", "_log_artist").agg(F.count(F.lit(1)).alias("n")))
    artists = broadcast_if_small(catalog_artist_keys(catalog, normalize), artist_broadcast_bytes)
    ids = distinct_ids(catalog, "id", "_id")
    flagged = (pairs
               .join(artists, F.col("_log_artist") == F.col("_artist_key"), "left")
               .join(ids, F.col("uri") == F.col("_id"), "left"))
    id_hit = F.col("_id").isNotNull()
    artist_hit = F.col("_artist_key").isNotNull()
    per_uri = flagged.groupBy("uri").agg(
        F.sum("n").alias("logs"),
        F.max(id_hit.cast("int")).alias("matched"),
        F.sum(F.when(~id_hit & artist_hit, F.col("n")).otherwise(0)).alias("artist_logs"),
    )
    totals = per_uri.agg(
        F.count("uri").alias("distinct_tracks"),
        F.coalesce(F.sum(F.when(F.col("uri").isNotNull(), F.col("matched"))), F.lit(0)).cast("long")
        .alias("matched_tracks"),
        F.coalesce(F.sum("logs"), F.lit(0)).cast("long").alias("total_logs"),
        F.coalesce(F.sum(F.when(F.col("matched") == 1, F.col("logs"))), F.lit(0)).cast("long").alias("track_logs"),
        F.coalesce(F.sum("artist_logs"), F.lit(0)).cast("long").alias("artist_logs"),
    )

    def pct(num: str, den: str):
        return F.bround(F.round(F.col(num) * 100.0 / F.nullif(F.col(den), F.lit(0)), 12), 2)

    return totals.select(
        "distinct_tracks", "matched_tracks", pct("matched_tracks", "distinct_tracks").alias("track_match_pct"),
        "total_logs", "track_logs", pct("track_logs", "total_logs").alias("track_logs_pct"),
        "artist_logs", pct("artist_logs", "total_logs").alias("artist_logs_pct"),
        (F.col("total_logs") - F.col("track_logs") - F.col("artist_logs")).alias("others_logs"),
        F.bround(F.round((F.col("total_logs") - F.col("track_logs") - F.col("artist_logs")) * 100.0
                         / F.nullif(F.col("total_logs"), F.lit(0)), 12), 2).alias("others_pct"),
        F.bround(F.round((F.col("track_logs") + F.col("artist_logs")) * 100.0
                         / F.nullif(F.col("total_logs"), F.lit(0)), 12), 2).alias("coverage_pct"),
    )


def unmatched_logs(history: DataFrame, catalog: DataFrame) -> DataFrame:
    """History rows whose track uri the catalog does not have (anti join)."""
    return history.join(distinct_ids(catalog, "id", "_id"), F.col("spotify_track_uri") == F.col("_id"), "left_anti")


def matched_logs(history: DataFrame, catalog: DataFrame) -> DataFrame:
    """History rows whose track uri the catalog has (semi join)."""
    return history.join(distinct_ids(catalog, "id", "_id"), F.col("spotify_track_uri") == F.col("_id"), "left_semi")
