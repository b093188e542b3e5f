"""File sources and sinks: catalog/history CSV (S5, S6) and the feature store."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from cadence.operators import prepare
from cadence.schemas import (
    ARTIST_PREFIX,
    CATALOG_FEATURES,
    CATALOG_SCHEMA,
    GLOBAL_KEY,
    RAW_HISTORY_SCHEMA,
    TRACK_PREFIX,
)

TIERS = ("tracks", "artists", "global")


def _csv(spark: SparkSession, schema):
    # RFC 4180 quoting (a quote inside a quoted field is doubled), as pandas writes it
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"').option("multiLine", False))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The song-feature catalog CSV (header row, explicit schema, no inference)."""
    return _csv(spark, CATALOG_SCHEMA).csv(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The raw listening-history CSV (header row; loose text/number columns)."""
    return _csv(spark, RAW_HISTORY_SCHEMA).csv(path)


def write_history(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write the cleaned history (Parquet by default, CSV with a header on request)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def write_feature_store(tracks: DataFrame, artists: DataFrame, global_row: DataFrame, path: str,
                        fmt: str = "parquet", track_buckets: int | None = None) -> None:
    """Write the three tiers under ``path``/{tracks,artists,global}.

    The track tier is range-partitioned on its id before writing, so each file
    covers one id range and row-group statistics let a keyed lookup skip most
    of them. ``fmt='json'`` writes the keyed JSON form (``key``, ``value``) instead.
    """
    if fmt == "json":
        keyed = prepare.feature_keys(tracks, artists, global_row)
        feats = [c for c in keyed.columns if c not in ("key", "scope")]
        keyed.select("key", F.to_json(F.struct(*feats)).alias("value")).write.mode("overwrite").json(
            os.path.join(path, "keyed"))
        return
    t = tracks.repartitionByRange(track_buckets, "id") if track_buckets else tracks.repartitionByRange("id")
    t.sortWithinPartitions("id").write.mode("overwrite").format(fmt).save(os.path.join(path, "tracks"))
    artists.write.mode("overwrite").format(fmt).save(os.path.join(path, "artists"))
    global_row.coalesce(1).write.mode("overwrite").format(fmt).save(os.path.join(path, "global"))


def features_of_json(keyed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tracks, artists, global) of the keyed JSON form; a feature that is absent or no number is 0.0."""
    schema = T.StructType([T.StructField(f, T.DoubleType()) for f in CATALOG_FEATURES])
    value = keyed.select("key", F.from_json("value", schema).alias("v"))
    feats = [F.coalesce(F.col(f"v.{f}"), F.lit(0.0)).alias(f) for f in CATALOG_FEATURES]

    def tier(prefix: str, name: str) -> DataFrame:
        return value.where(F.col("key").startswith(prefix)).select(
            F.substring(F.col("key"), F.lit(len(prefix) + 1), F.length("key")).alias(name), *feats)

    return tier(TRACK_PREFIX, "id"), tier(ARTIST_PREFIX, "artist"), value.where(F.col("key") == GLOBAL_KEY).select(*feats)


def store_version(spark: SparkSession, path: str) -> str:
    """Changes whenever the store under ``path`` is written again (times of its completed writes)."""
    jvm = spark._jvm
    out = []
    for part in ("keyed", *TIERS):
        p = jvm.org.apache.hadoop.fs.Path(os.path.join(path, part, "_SUCCESS"))
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(p):
            out.append(f"{part}:{fs.getFileStatus(p).getModificationTime()}")
    return ",".join(out)


def store_exists(spark: SparkSession, path: str) -> bool:
    """True when all three tiers, or their keyed JSON form, have been written under ``path``."""
    try:
        spark.read.schema("key string, value string").json(os.path.join(path, "keyed")).schema  # noqa: B018
        return True
    except AnalysisException:
        pass
    try:
        for t in TIERS:
            spark.read.parquet(os.path.join(path, t)).schema  # noqa: B018 (lists the files only)
        return True
    except AnalysisException:
        return False


def load_feature_store(spark: SparkSession, path: str, catalog: DataFrame | None = None,
                       validate: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tracks, artists, global) read from ``path``; built from ``catalog`` first when absent.

    With ``validate`` the track ids are checked for uniqueness before the
    store is written (a duplicate id would fan out the enrichment join).
    """
    if not store_exists(spark, path):
        if catalog is None:
            raise FileNotFoundError(f"no feature store at {path} and no catalog to build it from")
        clean = prepare.clean_catalog(catalog)
        if validate:
            prepare.assert_unique(clean, "id")
        write_feature_store(prepare.track_features(clean), prepare.artist_features(clean),
                            prepare.global_features(clean), path)
    try:
        return features_of_json(spark.read.schema("key string, value string").json(os.path.join(path, "keyed")))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return tuple(spark.read.parquet(os.path.join(path, t)) for t in TIERS)  # type: ignore[return-value]
