"""Per-batch result tables (A4-A6, T4) and their event-time window forms.

All are hash aggregates: Spark computes partial aggregates per task before
the shuffle, so a hot track costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions import instant_wallclock


def _stamp(df: DataFrame, batch_time: Column | None) -> DataFrame:
    return df if batch_time is None else df.withColumn("window_start_time", batch_time)


FIRST_AT = "_first_at"


def first_seen(*cols: str, order: str = "timestamp") -> Column:
    """Values of ``cols`` from the earliest row (ties broken by the values themselves).

    A fixed answer for the reference's order-dependent ``first``. Over many rows
    take it in two steps (:func:`earliest`): a struct with text has no
    fixed-width buffer and would be aggregated by sorting every row.
    """
    return F.min(F.struct(F.col(order), *[F.col(c) for c in cols]))


def earliest(events: DataFrame, keys: list[str], names: list[str], *sums: Column, order: str = "timestamp") -> DataFrame:
    """First step: one row per key and names, with the earliest time (``_first_at``) and partial sums.

    A hash aggregate with fixed-width buffers; the second step takes
    ``first_seen(*names, order=FIRST_AT)`` over the few rows of a key.
    """
    return events.groupBy(*keys, *names).agg(F.min(order).alias(FIRST_AT), *sums)


def leaderboard(events: DataFrame, batch_time: Column | None = None, keys: list[str] | None = None) -> DataFrame:
    """A4: plays per track with the first-seen track and artist name."""
    keys = keys or []
    names = ["track_name", "artist_name"]
    if events.isStreaming:  # one stateful step: state is kept per key, whatever its buffer
        g = events.groupBy(*keys, "track_uri").agg(first_seen(*names).alias("_first"), F.count(F.lit(1)).alias("play_count"))
    else:
        few = earliest(events, [*keys, "track_uri"], names, F.count(F.lit(1)).alias("_n"))
        g = few.groupBy(*keys, "track_uri").agg(
            first_seen(*names, order=FIRST_AT).alias("_first"), F.sum("_n").alias("play_count"))
    out = g.select(*keys, "track_uri", F.col("_first.track_name").alias("track_name"),
                   F.col("_first.artist_name").alias("artist_name"), "play_count")
    return _stamp(out, batch_time)


def mood_metrics(events: DataFrame, batch_time: Column | None = None, keys: list[str] | None = None) -> DataFrame:
    """A5: average valence and energy and the number of plays.

    The sums are kept beside the averages so rows can be re-weighted later
    (an average of per-batch averages is not the average of the plays).
    """
    keys = keys or []
    g = events.groupBy(*keys) if keys else events
    out = g.agg(
        F.avg("valence").alias("avg_valence"),
        F.avg("energy").alias("avg_energy"),
        F.count(F.lit(1)).alias("total_streams"),
        F.sum("valence").alias("sum_valence"),
        F.sum("energy").alias("sum_energy"),
    )
    return _stamp(out, batch_time)


def engagement(events: DataFrame, batch_time: Column | None = None, keys: list[str] | None = None) -> DataFrame:
    """Per track: average completion, skip count and natural-end count."""
    keys = keys or []
    skip = F.col("is_skip")
    out = events.groupBy(*keys, "track_uri").agg(
        F.avg("completion_rate").alias("completion_rate"),
        F.sum(F.when(skip, 1).otherwise(0)).alias("skip_count"),
        F.sum(F.when(~skip, 1).otherwise(0)).alias("natural_end_count"),
    )
    return _stamp(out, batch_time)


SAMPLE_COLUMNS = ["timestamp", "track_uri", "artist_name", "valence", "energy"]


def mood_sample(events: DataFrame, n: int = 200, mode: str = "limit") -> DataFrame:
    """T4 + P14: at most ``n`` scatter points.

    ``limit`` — any n rows, as the reference does (cheapest; not repeatable);
    ``newest`` — the n newest rows, ties broken by every column (repeatable);
    ``hash`` — n rows picked by a hash of their values (repeatable, spread over time).
    The ordered modes are a top-k: each task keeps its n best, one task merges them.
    """
    df = events.select(*SAMPLE_COLUMNS)
    if mode == "limit":
        return df.limit(n)
    if mode == "newest":
        return df.orderBy(F.col("timestamp").desc(), "track_uri", "artist_name", "valence", "energy").limit(n)
    if mode == "hash":
        return df.orderBy(F.xxhash64(*SAMPLE_COLUMNS), *SAMPLE_COLUMNS).limit(n)
    raise ValueError(f"unknown sample mode {mode!r}")


# --- W4: event-time tumbling windows -------------------------------------------

def _windowed(events: DataFrame, size: str, time_col: str) -> DataFrame:
    return events.withColumn("_w", F.window(time_col, size))


def _unwindow(df: DataFrame) -> DataFrame:
    # bounds are reported as wall-clock times, like the plays' own timestamps
    cols = [c for c in df.columns if c != "_w"]
    zoned = isinstance(df.schema["_w"].dataType["start"].dataType, T.TimestampType)
    start, end = F.col("_w.start"), F.col("_w.end")
    if zoned:   # windows over wallclock_instant(timestamp): map the bounds back without a zone
        start, end = instant_wallclock(start), instant_wallclock(end)
    return df.select(start.alias("window_start_time"), end.alias("window_end_time"), *cols)


def windowed_mood(events: DataFrame, size: str = "10 minutes", time_col: str = "timestamp") -> DataFrame:
    """A5 per event-time tumbling window."""
    return _unwindow(mood_metrics(_windowed(events, size, time_col), keys=["_w"]))


def windowed_leaderboard(events: DataFrame, size: str = "10 minutes", time_col: str = "timestamp") -> DataFrame:
    """A4 per event-time tumbling window."""
    return _unwindow(leaderboard(_windowed(events, size, time_col), keys=["_w"]))


def windowed_engagement(events: DataFrame, size: str = "10 minutes", time_col: str = "timestamp") -> DataFrame:
    """A6 per event-time tumbling window."""
    return _unwindow(engagement(_windowed(events, size, time_col), keys=["_w"]))


# --- W4: the same over salted keys, in two chained aggregations ------------------

def _salted(events: DataFrame, size: str, time_col: str, salts: int) -> DataFrame:
    # by the row's values: a task that runs again deals its rows as before
    return _windowed(events, size, time_col).withColumn("_salt", F.pmod(F.xxhash64(*events.columns), F.lit(salts)))


def _rewindowed(partial: DataFrame, size: str) -> DataFrame:
    """The window of the first step, from its event time: the second step then has a watermark of its own."""
    return partial.withColumn("_w", F.window(F.window_time("_w"), size))


def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(n))


def salted_mood(events: DataFrame, size: str, time_col: str, salts: int) -> DataFrame:
    """:func:`windowed_mood`; a window's plays are dealt over ``salts`` keys first."""
    part = _salted(events, size, time_col, salts).groupBy("_w", "_salt").agg(
        F.count(F.lit(1)).alias("_n"), *[f(c).alias(f"{p}{c}") for c in ("valence", "energy") for p, f in (("_s_", F.sum), ("_n_", F.count))])
    out = _rewindowed(part, size).groupBy("_w").agg(
        _mean("_s_valence", "_n_valence").alias("avg_valence"), _mean("_s_energy", "_n_energy").alias("avg_energy"),
        F.sum("_n").alias("total_streams"), F.sum("_s_valence").alias("sum_valence"), F.sum("_s_energy").alias("sum_energy"))
    return _unwindow(out)


def salted_leaderboard(events: DataFrame, size: str, time_col: str, salts: int) -> DataFrame:
    """:func:`windowed_leaderboard`; the first step keeps fixed-width state per track, names and salt."""
    names = ["track_name", "artist_name"]
    part = earliest(_salted(events, size, time_col, salts), ["_w", "_salt", "track_uri"], names, F.count(F.lit(1)).alias("_n"))
    out = _rewindowed(part, size).groupBy("_w", "track_uri").agg(
        first_seen(*names, order=FIRST_AT).alias("_first"), F.sum("_n").alias("play_count"))
    return _unwindow(out.select("_w", "track_uri", F.col("_first.track_name").alias("track_name"),
                                F.col("_first.artist_name").alias("artist_name"), "play_count"))


def salted_engagement(events: DataFrame, size: str, time_col: str, salts: int) -> DataFrame:
    """:func:`windowed_engagement`; a track's plays are dealt over ``salts`` keys first."""
    skip = F.col("is_skip")
    part = _salted(events, size, time_col, salts).groupBy("_w", "_salt", "track_uri").agg(
        F.sum("completion_rate").alias("_s"), F.count("completion_rate").alias("_n"),
        F.sum(F.when(skip, 1).otherwise(0)).alias("_skips"), F.sum(F.when(~skip, 1).otherwise(0)).alias("_ends"))
    return _unwindow(_rewindowed(part, size).groupBy("_w", "track_uri").agg(
        _mean("_s", "_n").alias("completion_rate"), F.sum("_skips").alias("skip_count"), F.sum("_ends").alias("natural_end_count")))
