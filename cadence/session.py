"""Session helpers: the settings the engine expects, and the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings the queries are written for. AQE re-plans joins from measured shuffle
# sizes (runtime broadcast, skew split, partition coalescing).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "cadence", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    """The application id, read from the session conf (works for classic and Connect sessions)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # a Connect session has no SparkContext
        return None


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or _context_checkpoint_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Raises when none is configured: callers on a cluster must name a shared
    folder; tests set one explicitly with :func:`ensure_checkpoint_dir`.
    """
    d = configured_checkpoint_dir(spark)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the configured checkpoint folder; set ``fallback`` only where none is set (tests)."""
    d = configured_checkpoint_dir(spark)
    if not d:
        # spark.checkpoint.dir cannot change at runtime; the context's folder can
        try:
            spark.sparkContext.setCheckpointDir(fallback)
            d = spark.sparkContext.getCheckpointDir() or fallback
        except Exception:  # Connect session: use the folder for our own tables only
            d = fallback
    return d.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: the checkpoint folder, or the warehouse where none is named.

    Both are shared by the driver and the executors of a cluster.
    """
    return (configured_checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for one run's tables and stream state."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables on whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
