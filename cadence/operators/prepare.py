"""Batch preparation: catalog and history cleaning, the three feature tiers,
key checks and the keyed feature set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions import first_artist, format_ts, read_ts, prefixed_key, round4, truthy_text
from cadence.schemas import (
    ARTIST_PREFIX,
    CATALOG_FEATURES,
    GLOBAL_KEY,
    HISTORY_REQUIRED,
    TRACK_PREFIX,
)


class DuplicateKeyError(ValueError):
    pass


def clean_catalog(catalog: DataFrame) -> DataFrame:
    """P1 + P2 + F1: keep id, artists and the 13 features; drop rows with any null/NaN;
    add ``artist`` = first listed artist."""
    cols = ["id", "artists"] + CATALOG_FEATURES
    return catalog.select(*cols).na.drop("any", subset=cols).withColumn("artist", first_artist("artists"))


def track_features(clean: DataFrame) -> DataFrame:
    """A3: per-track features rounded to four places (half-even)."""
    return clean.select("id", *[round4(f).alias(f) for f in CATALOG_FEATURES])


def artist_features(clean: DataFrame) -> DataFrame:
    """A1: mean of the 13 features per first-listed artist, rounded to four places.

    Averages are algebraic, so Spark combines them map-side before the shuffle;
    a hot artist costs one partial row per task, not one row per track. Tracks
    without a first artist belong to no mean.
    """
    return clean.where(F.col("artist").isNotNull()).groupBy("artist").agg(*[round4(F.avg(f)).alias(f) for f in CATALOG_FEATURES])


def global_features(clean: DataFrame) -> DataFrame:
    """A2: one row of global feature means, rounded to four places."""
    return clean.agg(*[round4(F.avg(f)).alias(f) for f in CATALOG_FEATURES])


def feature_tiers(catalog: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(track, artist, global) tiers from a raw catalog."""
    clean = clean_catalog(catalog)
    return track_features(clean), artist_features(clean), global_features(clean)


def clean_history(raw: DataFrame) -> DataFrame:
    """The listening history as log records.

    Rows without ts, track uri or artist are dropped; ms_played is truncated to
    int, and null, NaN or a number outside int (over 24 days) becomes 0; shuffle/skipped become booleans ('TRUE' in any case);
    ts becomes ``yyyy-MM-dd HH:mm:ss`` text. Rows whose ts cannot be read are
    dropped as well (the reference would stop on them). Other columns pass through.
    """
    df = raw.na.drop("any", subset=HISTORY_REQUIRED)
    ts_type = df.schema["ts"].dataType
    ts_value = F.col("ts") if isinstance(ts_type, (T.TimestampType, T.TimestampNTZType, T.DateType)) \
        else read_ts(F.col("ts"))
    cleaned = {
        "ts": format_ts(ts_value),
        "ms_played": F.coalesce(F.nanvl(F.col("ms_played").try_cast("double"), F.lit(0.0)).try_cast("int"), F.lit(0)),
        "shuffle": truthy_text("shuffle"),
        "skipped": truthy_text("skipped"),
    }
    out = df.select(*[cleaned.get(c, F.col(c)).alias(c) for c in df.columns])
    return out.where(F.col("ts").isNotNull())


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Q1: keys that occur more than once, with their count ``n``."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def assert_unique(df: DataFrame, key: str | list[str]) -> None:
    """Raise when ``key`` is not unique (one small job; at most one key reaches the driver)."""
    dup = duplicate_keys(df, key).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key {dup[0].asDict()}")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row (anti join)."""
    pk = parent_key or child_key
    parent_keys = parent.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull())
    return (child.where(F.col(child_key).isNotNull())
            .join(parent_keys, F.col(child_key) == F.col("_pk"), "left_anti"))


def feature_keys(tracks: DataFrame, artists: DataFrame, global_row: DataFrame) -> DataFrame:
    """The three tiers as one keyed set (``key``, ``scope``, 13 features as double)."""
    feats = [F.col(f).cast("double").alias(f) for f in CATALOG_FEATURES]
    t = tracks.select(prefixed_key(TRACK_PREFIX, "id").alias("key"), F.lit("track").alias("scope"), *feats)
    a = artists.select(prefixed_key(ARTIST_PREFIX, "artist").alias("key"), F.lit("artist").alias("scope"), *feats)
    g = global_row.select(F.lit(GLOBAL_KEY).alias("key"), F.lit("global").alias("scope"), *feats)
    return t.unionByName(a).unionByName(g)
