"""Checked broadcast: broadcast a join side only after measuring it.

The check runs one small aggregate over the candidate side and returns two
numbers to the driver (row count and total string bytes); nothing else
leaves the executors. Above the limit the side is left to the planner,
which shuffles both sides (sort-merge join), and AQE may still switch to a
broadcast from the measured shuffle size or split skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Per-row overhead of an UnsafeRow-backed hashed relation (header + pointers).
ROW_OVERHEAD_BYTES = 32

_FIXED = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.LongType: 8, T.DoubleType: 8, T.FloatType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def _fixed_width(schema: T.StructType) -> tuple[int, list[str]]:
    width, var = 0, []
    for f in schema.fields:
        size = next((v for k, v in _FIXED.items() if isinstance(f.dataType, k)), None)
        if size is None:
            var.append(f.name)
            width += 8
        else:
            width += 8 if size < 8 else size
    return width, var


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of ``df`` as a broadcast relation, from its actual rows."""
    width, var = _fixed_width(df.schema)
    exprs = [F.count(F.lit(1)).alias("n")]
    exprs += [F.coalesce(F.sum(F.octet_length(F.col(c).cast("string"))), F.lit(0)).alias(f"v{i}")
              for i, c in enumerate(var)]
    row = df.agg(*exprs).first()
    n = int(row["n"])
    return n * (width + ROW_OVERHEAD_BYTES) + sum(int(row[f"v{i}"]) for i in range(len(var)))


def broadcast_limit(df: DataFrame, default: int = DEFAULT_MAX_BROADCAST_BYTES) -> int:
    """The session's limit: -1 (broadcast disabled) wins, else ``default``."""
    conf = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        if int(str(conf).lower().rstrip("b")) < 0:
            return -1
    except ValueError:
        pass
    return default


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when its measured size is within the limit, else ``df`` unchanged."""
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if limit < 0:
        return df
    return F.broadcast(df) if measured_bytes(df) <= limit else df
