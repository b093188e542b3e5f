"""Hot-key split for joins where AQE cannot split skew.

AQE splits a skewed partition only when both join inputs are shuffle
stages. A join against a persisted, pre-partitioned table (the streaming
track tier) is not, so a key holding a third of the rows would run in one
task. Here the hot keys are found first — keys with at least ``fraction`` of
the rows, so there are at most ``1 / fraction`` of them — and their rows
meet a broadcast copy of just the matching right-side rows, map-side and
spread over all tasks; every other row takes the normal join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators.sizing import broadcast_if_small

HOT_KEY = "_hot_key"


def hot_keys(df: DataFrame, key: str, fraction: float, rows: int | None = None) -> DataFrame:
    """Keys of ``df`` that hold at least ``fraction`` of its rows (at most ``1/fraction`` keys).

    ``rows`` is the row count of ``df`` when the caller already has it.
    """
    n = df.count() if rows is None else rows
    threshold = max(1, math.ceil(n * fraction))
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= threshold).select(F.col(key).alias(HOT_KEY)))


def split_hot_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left",
                   fraction: float = 0.01, max_broadcast_bytes: int | None = None,
                   left_rows: int | None = None) -> DataFrame:
    """``left.join(right, left_key == right_key, how)`` with hot keys joined map-side.

    Rows without a key match nothing, so they stay where they are, on the map-side half.

    ``left`` is read three times (hot-key count, hot rows, other rows):
    persist it first when it is not a table scan. The hot keys are counted once; as there are at most
    ``1 / fraction`` of them, the plan holds them as values. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("split_hot_join supports inner and left joins")
    found = hot_keys(left, left_key, fraction, left_rows)
    hot = F.broadcast(left.sparkSession.createDataFrame(found.collect(), found.schema))   # <= 1/fraction rows
    flagged = left.join(hot, F.col(left_key) == F.col(HOT_KEY), "left")
    stays = F.col(HOT_KEY).isNotNull() | F.col(left_key).isNull()
    hot_rows = flagged.where(stays).drop(HOT_KEY)
    cold_rows = flagged.where(~stays).drop(HOT_KEY)
    hot_right = right.join(hot, F.col(right_key) == F.col(HOT_KEY), "left_semi")
    hot_right = broadcast_if_small(hot_right, max_broadcast_bytes)
    hot_joined = hot_rows.join(hot_right, F.col(left_key) == F.col(right_key), how)
    cold_joined = cold_rows.join(right, F.col(left_key) == F.col(right_key), how)
    return hot_joined.unionByName(cold_joined)
