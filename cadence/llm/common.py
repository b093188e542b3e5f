"""Shared helpers: the folder for written intermediate tables, table reading, vector tokenising."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import shared_dir


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="cadence-code-")  # the driver's own: Spark serves the file from here
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.addPyFile(shutil.make_archive(os.path.join(folder, "cadence"), "zip", os.path.dirname(package), os.path.basename(package)))
        _SHIPPED.add(sc.applicationId)
    return spark


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return os.path.join(shared_dir(spark), "cadence-llm", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back: lineage ends here."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> Column:
    """128 bits that stand for a row's doc_id and text; a null isn't an empty text, nor a null id any other."""
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(named, F.when(F.col("text").isNull(), "-").otherwise("+"), F.coalesce(F.col("text").cast("string"), F.lit("")))))


def hash_share(share: float, *columns: str) -> Column:
    """True for about ``share`` of the rows, by a hash of the columns: the same rows in every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def sampled(rows: DataFrame, share: float, keep: str, *columns: str) -> DataFrame:
    """About ``share`` of the different rows by ``columns``, each once, with the columns and ``keep``.

    Rows that are repeated ever so often count as one, so that the sample stays as small as it is meant.
    """
    picked = rows.filter(hash_share(share, *columns, keep))
    return picked.groupBy(*columns, F.xxhash64(keep).alias("_hash")).agg(F.first(keep).alias(keep)).drop("_hash")


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow string column as (all bytes, n + 1 offsets); a null has length zero."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def small(batches, column: str = "text", most: int = 4 << 20, rows: int = 2048):
    """The batches in slices of about ``most`` bytes of the text column (at least one row)."""
    for b in batches:
        _, at = text_bytes(b.column(column))
        first = 0
        while first < b.num_rows:
            to = max(first + 1, min(first + rows, int(np.searchsorted(at, at[first] + most, "right")) - 1))
            yield b.slice(first, to - first)
            first = to


def runs_of(values: np.ndarray) -> np.ndarray:
    """Start of each run of equal values."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
